"""Evaluation queries over question-answer pairs, labels and run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import patterns as pt
from corpusloom.functions import text as tx
from corpusloom.operators import evaluation as ev
from corpusloom.operators import monitoring as mo
from corpusloom.plans.corpus_queries import sql_squeeze, sql_tokens
from corpusloom.plans.monitoring_queries import HALF, halves
from corpusloom.plans.registry import query
from corpusloom.plans.retrieval_queries import config_contexts, context_cte, relevance_cte, sql_list
from corpusloom.plans.shared import r6, rounded
from corpusloom.sources.bindings import docs, qa, questions, traffic
from corpusloom.sources.tables import table

Q = ("v_qa",)


def terms_sql(c: str, stop) -> str:
    return f"list_filter(list_distinct({sql_tokens(f'lower({c})')}), lambda w: NOT list_contains({sql_list(stop)}, w))"


SIGNAL_CTE = f"""tm AS (SELECT *, {terms_sql('question', pt.SIGNAL_STOP)} AS tq, {terms_sql('context', pt.SIGNAL_STOP)} AS tc, {terms_sql('answer', pt.SIGNAL_STOP)} AS ta,
  len({sql_tokens('context')}) AS context_words, len({sql_tokens('answer')}) AS answer_words FROM v_qa),
sg AS (SELECT conv_id, turn, question, context, answer, ground_truth, context_words, answer_words, context_words < 20 AS context_too_short,
  answer_words / CAST(greatest(context_words, 1) AS DOUBLE) AS answer_context_ratio, answer_words > context_words AS answer_longer,
  len(list_intersect(ta, tc)) / CAST(greatest(len(ta), 1) AS DOUBLE) AS grounded_ratio, len(list_intersect(tq, tc)) / CAST(greatest(len(tq), 1) AS DOUBLE) AS context_relevance FROM tm),
sf AS (SELECT *, grounded_ratio < CAST(0.3 AS DOUBLE) AS potential_hallucination, context_relevance < CAST(0.2 AS DOUBLE) AS irrelevant_context FROM sg)"""


@query("grounding_signals", f"""WITH {SIGNAL_CTE} SELECT conv_id, turn, context_words, answer_words, context_too_short, {r6('answer_context_ratio')} AS answer_context_ratio, answer_longer,
  {r6('grounded_ratio')} AS grounded_ratio, potential_hallucination, {r6('context_relevance')} AS context_relevance, irrelevant_context FROM sf""", Q)
def _(spark, root):
    return rounded(ev.grounding_signals(qa(spark, root)).drop("question", "context", "answer", "ground_truth"))


RISK_CTE = f"""rt AS (SELECT conv_id, turn, {terms_sql('answer', pt.GROUNDING_STOP)} AS r, {terms_sql('context', pt.GROUNDING_STOP)} AS c FROM v_qa),
ro AS (SELECT conv_id, turn, len(r) AS response_terms, len(list_intersect(r, c)) AS matching_terms,
  CASE WHEN len(r) = 0 THEN CAST(1 AS DOUBLE) ELSE len(list_intersect(r, c)) / CAST(len(r) AS DOUBLE) END AS overlap FROM rt),
rk AS (SELECT *, CASE WHEN overlap >= CAST(0.5 AS DOUBLE) THEN 'LOW' WHEN overlap >= CAST(0.3 AS DOUBLE) THEN 'MEDIUM' ELSE 'HIGH' END AS risk FROM ro)"""


@query("grounding_risk", f"WITH {RISK_CTE} SELECT conv_id, turn, response_terms, matching_terms, {r6('overlap')} AS overlap, risk, risk <> 'HIGH' AS grounded FROM rk", Q)
def _(spark, root):
    return rounded(ev.grounding_risk(qa(spark, root)).drop("question", "context", "answer", "ground_truth"))


@query("hallucination_rate", f"""WITH {RISK_CTE} SELECT count(*) AS total_checks, count(*) FILTER (risk = 'HIGH') AS ungrounded,
  {r6("count(*) FILTER (risk = 'HIGH') * 100.0 / count(*)")} AS hallucination_rate, count(*) FILTER (risk = 'HIGH') AS high_risk FROM rk""", Q)
def _(spark, root):
    return rounded(ev.hallucination_rate(ev.grounding_risk(qa(spark, root))))


def _any(c: str, words) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(c, w.lower().replace("'", "''")) for w in words) + ")"


@query("response_checks", f"""SELECT conv_id, turn, contains(answer, 'I don''t have enough information') OR
  len(list_filter(string_split(context, chr(10)), lambda x: x <> '' AND contains(lower(answer), lower(x)))) > 0 AS grounding,
  {_any('lower(answer)', pt.SAFETY_PHRASES)} AS safety, NOT {_any('lower(answer)', pt.HEDGING_PHRASES)} AS hallucination_prevention FROM v_qa""", Q)
def _(spark, root):
    chunks = F.filter(F.split("context", "\n"), lambda c: c != "")
    return ev.response_checks(qa(spark, root), chunks).select("conv_id", "turn", "grounding", "safety", "hallucination_prevention")


FAIL_CTE = SIGNAL_CTE + """,
sc AS (SELECT sf.*, coalesce(1 + 4 * quality, 3) AS gs, coalesce(5 - 4 * toxic, 3) AS cs FROM sf LEFT JOIN labels ON doc_id = conv_id),
fl AS (SELECT *, CASE WHEN irrelevant_context THEN 'RETRIEVAL_FAILURE' WHEN potential_hallucination THEN 'MODEL_FAILURE'
  WHEN gs >= 4 AND cs <= 2 THEN 'PROMPT_FAILURE' ELSE 'NO_CLEAR_FAILURE' END AS failure_type FROM sc)"""


def scored_signals(spark, root):
    labels = table(spark, root, "labels").select(F.col("doc_id").alias("conv_id"), (1 + 4 * F.col("quality")).alias("g"), (5 - 4 * F.col("toxic")).alias("c"))
    s = ev.grounding_signals(qa(spark, root)).join(labels, "conv_id", "left")
    return s.withColumn("grounded_score", ev.clamp_score(F.col("g"))).withColumn("correct_score", ev.clamp_score(F.col("c"))).drop("g", "c")


def failures(spark, root):
    return ev.classify_failures(scored_signals(spark, root), "grounded_score", "correct_score")


@query("failure_classes", f"""WITH {FAIL_CTE} SELECT conv_id, turn, failure_type, CAST(CASE failure_type WHEN 'RETRIEVAL_FAILURE' THEN 0.8 WHEN 'MODEL_FAILURE' THEN 0.7
  WHEN 'PROMPT_FAILURE' THEN 0.6 ELSE 0.5 END AS DOUBLE) AS confidence FROM fl""", Q)
def _(spark, root):
    return failures(spark, root).select("conv_id", "turn", "failure_type", "confidence")


@query("failure_distribution", f"""WITH {FAIL_CTE} SELECT failure_type, count(*) AS failures, arg_min(question, conv_id * 100000 + turn) AS example,
  {r6('count(*) * 100.0 / (SELECT count(*) FROM fl)')} AS percent FROM fl GROUP BY failure_type""", Q)
def _(spark, root):
    return rounded(ev.failure_distribution(failures(spark, root), ["conv_id", "turn"], "question"))


KW_SQL = f"list_filter({sql_tokens('lower(ground_truth)')}, lambda w: length(w) > 3)[1:5]"


@query("keyword_match_rate", f"""WITH k AS (SELECT conv_id, turn, answer, {KW_SQL} AS kw FROM v_qa)
  SELECT conv_id, turn, {r6("CASE WHEN len(kw) > 0 THEN len(list_filter(kw, lambda w: contains(lower(answer), w))) * 100.0 / len(kw) END")} AS match_rate FROM k""", Q)
def _(spark, root):
    expected = F.slice(F.filter(tx.tokens(F.lower("ground_truth")), lambda w: F.length(w) > 3), 1, 5)
    return rounded(ev.keyword_match(qa(spark, root), expected).select("conv_id", "turn", "match_rate"))


@query("score_means", f"""WITH s AS (SELECT lang, 5 * quality AS quality, 5 - 7 * toxic AS safety FROM documents LEFT JOIN labels USING (doc_id))
  SELECT lang, count(*) AS rows, {r6('avg(CASE WHEN quality IS NULL THEN 3 ELSE least(greatest(quality, 1), 5) END)')} AS quality_mean, {r6('avg(CASE WHEN safety IS NULL THEN 3 ELSE least(greatest(safety, 1), 5) END)')} AS safety_mean FROM s GROUP BY lang""")
def _(spark, root):
    judged = table(spark, root, "labels").select("doc_id", (5 * F.col("quality")).alias("quality"), (5 - 7 * F.col("toxic")).alias("safety"))
    d = table(spark, root, "documents").select("doc_id", "lang").join(judged, "doc_id", "left").drop("doc_id")
    return rounded(ev.score_means(d, ["quality", "safety"], ["lang"]))


@query("signal_vs_score", f"""WITH {FAIL_CTE} SELECT count(*) AS samples, count(*) FILTER (context_too_short) AS n_context_too_short, count(*) FILTER (answer_longer) AS n_answer_longer,
  count(*) FILTER (potential_hallucination) AS n_potential_hallucination, count(*) FILTER (irrelevant_context) AS n_irrelevant_context,
  {r6('avg(gs) FILTER (potential_hallucination)')} AS score_with_flag, {r6('avg(gs) FILTER (NOT potential_hallucination)')} AS score_without_flag FROM fl""", Q)
def _(spark, root):
    return rounded(ev.signal_vs_score(scored_signals(spark, root), "grounded_score"))


@query("config_comparison", f"""WITH {relevance_cte(8)},
cf AS (SELECT unnest([3, 5, 8]) AS top_k, unnest([2000, 4000, 6000]) AS max_chars),
hc AS (SELECT h.*, top_k, max_chars FROM h, cf WHERE rank <= top_k),
{context_cte('hc', 'max_chars', 'query_id, top_k, max_chars')},
r AS (SELECT top_k, query_id, len({sql_tokens('context')}) AS tokens, passages FROM ctx),
g AS (SELECT top_k, count(*) AS queries, CAST(sum(tokens) AS BIGINT) AS total_tokens, avg(tokens) AS avg_tokens, max(tokens) AS max_tokens, min(tokens) AS min_tokens, avg(passages) AS avg_docs,
  sum(tokens) * 0.00002::DOUBLE AS total_cost FROM r GROUP BY top_k)
SELECT CAST(top_k AS INT) AS top_k, queries, total_tokens, {r6('avg_tokens')} AS avg_tokens, max_tokens, min_tokens, {r6('avg_docs')} AS avg_docs, {r6('total_cost')} AS total_cost,
  {r6('total_cost / (SELECT queries FROM g WHERE top_k = 3)')} AS cost_per_query, round(total_cost / (SELECT total_cost FROM g WHERE top_k = 3) * 100, 1) AS relative_cost_pct,
  {r6('total_cost / queries * 1000')} AS monthly_cost FROM g""", ("v_docs", "v_questions"))
def _(spark, root):
    runs = config_contexts(spark, root).select("top_k", "query_id", tx.word_count(F.col("context")).alias("tokens"), F.col("passages").alias("docs"))
    return rounded(ev.compare_configs(runs, "top_k", 3))


@query("optimisation_saving", f"""WITH t AS (SELECT len({sql_tokens('question')}) + len({sql_tokens('context')}) AS b,
  len({sql_tokens(sql_squeeze('question'))}) + CASE WHEN len({sql_tokens('context')}) > 150 THEN 150 ELSE len({sql_tokens('context')}) END AS o FROM v_qa)
  SELECT count(*) AS queries, CAST(sum(b) AS BIGINT) AS baseline_tokens, CAST(sum(o) AS BIGINT) AS optimized_tokens, {r6('avg(b - o)')} AS avg_reduction,
  {r6('(sum(b) - sum(o)) / sum(b) * 100')} AS reduction_pct, {r6('(sum(b) - sum(o)) / 1000 * 0.002::DOUBLE')} AS cost_saving FROM t""", Q)
def _(spark, root):
    short, _ = tx.first_words(F.col("context"), 150)
    return rounded(ev.optimisation_saving(qa(spark, root).select(
        (tx.word_count(F.col("question")) + tx.word_count(F.col("context"))).alias("baseline_tokens"),
        (tx.word_count(tx.squeeze(F.col("question"))) + tx.word_count(short)).alias("optimized_tokens"),
    )))


def _variant_sql(cond: str) -> str:
    return f"""SELECT category, complexity, 1 + 4 * avg(quality_score) AS q, 1 + 4 * avg(CASE WHEN total_tokens > 40 THEN CAST(1 AS DOUBLE) ELSE 0 END) AS g,
  quantile_cont(latency_ms, 0.95) AS l, avg(total_tokens) AS c FROM v_traffic WHERE {cond} GROUP BY ALL"""


@query("deploy_decision", f"""WITH b AS ({_variant_sql(f"ts < TIMESTAMP '{HALF}'")}), o AS ({_variant_sql(f"ts >= TIMESTAMP '{HALF}'")}),
d AS (SELECT category, complexity, (o.q - b.q) / greatest(b.q, 1) * 100 AS q, (o.g - b.g) / greatest(b.g, 1) * 100 AS g, (o.l - b.l) / greatest(b.l, 1) * 100 AS l, (o.c - b.c) / greatest(b.c, 1) * 100 AS c FROM b JOIN o USING (category, complexity)),
e AS (SELECT *, CASE WHEN q > -1 AND c <= -30 THEN 1 WHEN q >= -5 AND g >= -10 AND c <= -40 THEN 2 WHEN q >= -5 AND g >= -10 AND c <= -20 THEN 3 WHEN q < -10 OR g < -15 THEN 4 WHEN c > -20 THEN 5 ELSE 6 END AS r FROM d)
SELECT category, complexity, {r6('q')} AS quality_change_pct, {r6('g')} AS groundedness_change_pct, {r6('l')} AS latency_change_pct, {r6('c')} AS cost_change_pct,
  (['DEPLOY', 'DEPLOY', 'DEPLOY', 'REJECT', 'REJECT', 'REVIEW'])[r] AS recommendation, CAST(([0.95, 0.85, 0.75, 0.90, 0.80, 0.60])[r] AS DOUBLE) AS confidence,
  (['LOW', 'LOW-MEDIUM', 'MEDIUM', 'HIGH', 'N/A', 'MEDIUM'])[r] AS risk FROM e""", ("v_traffic",))
def _(spark, root):
    def variant(log):
        return mo.exact_percentiles(log, "latency_ms", {"latency_p95": 0.95}, by=["category", "complexity"], extra=[
            (1 + 4 * F.avg("quality_score")).alias("correctness_mean"),
            (1 + 4 * mo.share(F.col("total_tokens") > 40)).alias("groundedness_mean"),
            F.avg("total_tokens").alias("avg_tokens"),
        ])

    old, new = halves(traffic(spark, root))
    return rounded(ev.deploy_decision(variant(old), variant(new), ["category", "complexity"]))


@query("relevant_in_corpus", """WITH w AS (SELECT query_id, unnest([query_id, query_id + 500, query_id + 5000]) AS doc_id FROM v_questions)
  SELECT query_id, count(*) AS relevant, count(d.doc_id) AS indexed FROM w LEFT JOIN documents d ON w.doc_id = d.doc_id GROUP BY query_id""", ("v_questions",))
def _(spark, root):
    i = F.col("query_id")
    return ev.relevant_in_corpus(questions(spark, root).select("query_id", F.array(i, i + 500, i + 5000).alias("relevant_doc_ids")), docs(spark, root))


def gram_sql(c: str, n: int = 5) -> str:
    return f"list_transform(range(1, len({c}) - {n - 2}), lambda i: array_to_string({c}[i:i + {n - 1}], ' '))"


@query("evaluation_overlap", f"""WITH bt AS (SELECT item_id, {sql_tokens('lower(text)')} AS w FROM benchmark), dt AS (SELECT {sql_tokens('lower(text)')} AS w FROM documents),
bg AS (SELECT DISTINCT item_id, unnest({gram_sql('w')}) AS gram FROM bt), dg AS (SELECT DISTINCT unnest({gram_sql('w')}) AS gram FROM dt)
SELECT item_id, count(*) AS grams, count(dg.gram) AS grams_found, {r6('count(dg.gram) / CAST(count(*) AS DOUBLE)')} AS containment FROM bg LEFT JOIN dg USING (gram) GROUP BY item_id""")
def _(spark, root):
    return rounded(ev.ngram_containment(table(spark, root, "benchmark"), docs(spark, root), "item_id", "text", "doc_id", "content"))
