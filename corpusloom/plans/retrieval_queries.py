"""Embedding, retrieval and answer queries. Questions are the benchmark table, the corpus is documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import answers as an
from corpusloom.operators import embedding as em
from corpusloom.operators import retrieval as rt
from corpusloom.operators import vector_cells as vc
from corpusloom.operators import vector_store as vs
from corpusloom.plans.corpus_queries import WSQ, sql_squeeze, sql_tokens, sync_inputs
from corpusloom.plans.monitoring_queries import DIAG_LATENCY_CTE, HIGH, SLA
from corpusloom.operators import monitoring as mo
from corpusloom.plans.registry import query
from corpusloom.plans.shared import r6, rounded
from corpusloom.sources.bindings import claims, docs, policies, prompts, question_vectors, questions, traffic
from corpusloom.sources.tables import table
from corpusloom.session import scratch_path

DQ = ("v_docs", "v_questions")
VQ = ("v_question_vectors",)


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def vectors(spark, root):
    return table(spark, root, "embeddings").select("vec_id", "embedding", F.col("label").alias("category"))


# ---- embedding

@query("text_embeddings")
def _(spark, root):
    return em.hashed_embeddings(docs(spark, root).select("doc_id", "content"), "content").select("doc_id", "embedding")


@query("pending_embeddings", """WITH ix AS (SELECT DISTINCT d.text AS content FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id)
  SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents d ANTI JOIN ix ON d.text = ix.content GROUP BY text""")
def _(spark, root):
    _, indexed = sync_inputs(spark, root)
    return em.pending_texts(docs(spark, root), indexed).select("doc_id", "copies")


@query("embedded_corpus", """SELECT doc_id, length(text) > 10 AS has_vector, CAST(CASE WHEN text IN (SELECT d.text FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id) THEN 0 ELSE 1 END AS BIGINT) AS run,
  count(*) OVER (PARTITION BY text) AS copies FROM documents""")
def _(spark, root):
    """Labelled documents are embedded by a first run, the rest of the corpus by a second."""
    path, d = scratch_path(spark, "vector-store"), docs(spark, root).select("doc_id", "content")
    vs.embed_new(sync_inputs(spark, root)[1], path, 0)
    vs.embed_new(d, path, 1)
    copies = d.groupBy(vs.content_digest("content").alias("g")).agg(F.count(F.lit(1)).alias("copies"))
    found = vs.with_vectors(d, path).withColumn("g", vs.content_digest("content")).drop("content")
    return found.join(copies, "g").select("doc_id", F.col("embedding").isNotNull().alias("has_vector"), "run", "copies")


@query("vector_health", f"""SELECT label, count(*) AS vectors, count(*) FILTER (embedding IS NULL) AS nulls, CAST(min(len(embedding)) AS INT) AS min_dim,
  CAST(max(len(embedding)) AS INT) AS max_dim, {r6("min(n)")} AS min_norm, {r6("max(n)")} AS max_norm, count(*) FILTER (len(embedding) <> 64) AS wrong_dim
  FROM (SELECT *, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS n FROM embeddings) GROUP BY label""")
def _(spark, root):
    return rounded(em.vector_health(table(spark, root, "embeddings"), expected_dim=64))


# ---- vector search

def vector_cte(name: str, k: int, extra: str = "") -> str:
    return f"""{name} AS (SELECT query_id, vec_id AS hit_id, label, q.category, {r6("list_cosine_similarity(query_vec, CAST(embedding AS DOUBLE[]))")} AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY {r6("list_cosine_similarity(query_vec, CAST(embedding AS DOUBLE[]))")} DESC, vec_id) AS rank
  FROM v_question_vectors q, embeddings e WHERE vec_id <> query_id {extra} QUALIFY rank <= {k})"""


def qvec(spark, root):
    return question_vectors(spark, root).select("query_id", "query_vec", "category")


@query("vector_search", f"WITH {vector_cte('h', 10)} SELECT query_id, hit_id, score, rank FROM h", VQ)
def _(spark, root):
    return rt.vector_search(vectors(spark, root), qvec(spark, root), 10)


@query("filtered_vector_search", f"WITH {vector_cte('h', 5, 'AND label = category')} SELECT query_id, hit_id, score, rank FROM h", VQ)
def _(spark, root):
    return rt.vector_search(vectors(spark, root), qvec(spark, root), 5, filtered=True)


@query("approximate_search_recall")
def _(spark, root):
    v, q = vectors(spark, root), qvec(spark, root)
    exact = rt.vector_search(v, q, 10)
    celled, centres = rt.assign_cells(v)
    return rt.recall_at_k(rt.approximate_search(celled, centres, q, 10), exact)


CELLS, PROBES = 16, 6
STORED_CTE = f"""ev AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
ce AS (SELECT CAST(row_number() OVER (ORDER BY sha256(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS INT) AS cell, v FROM ev QUALIFY row_number() OVER (ORDER BY sha256(CAST(vec_id AS VARCHAR)), vec_id) <= {CELLS}),
cv AS (SELECT vec_id, ev.v, cell FROM ev, ce QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(ev.v, ce.v), 9) DESC, cell) = 1),
pr AS (SELECT query_id, query_vec, cell FROM v_question_vectors, ce QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(query_vec, ce.v), 9) DESC, cell) <= {PROBES}),
st AS (SELECT query_id, vec_id AS hit_id, {r6("list_cosine_similarity(query_vec, v)")} AS score FROM pr JOIN cv USING (cell) WHERE vec_id <> query_id),
stored AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hit_id) AS rank FROM st QUALIFY rank <= 10)"""


def stored_search(spark, root):
    v, q = vectors(spark, root).select("vec_id", "embedding"), qvec(spark, root)
    path = scratch_path(spark, "vector-cells")
    centres = vc.fixed_centres(v, CELLS)
    vc.write_cells(v, centres, path)
    return vc.search_cells(spark, path, centres, q, 10, PROBES)


@query("stored_search", f"WITH {STORED_CTE} SELECT query_id, hit_id, score, rank FROM stored", VQ)
def _(spark, root):
    return stored_search(spark, root)


@query("stored_search_recall", f"""WITH {STORED_CTE}, {vector_cte('ex', 10)}
SELECT count(*) AS expected, count(stored.hit_id) AS found, count(stored.hit_id) / CAST(count(*) AS DOUBLE) AS recall FROM ex LEFT JOIN stored USING (query_id, hit_id)""", VQ)
def _(spark, root):
    return rt.recall_at_k(stored_search(spark, root), rt.vector_search(vectors(spark, root), qvec(spark, root), 10))


# ---- keyword search

DL_CTE = "dl AS MATERIALIZED (SELECT doc_id, lower(content) AS c, lower(title) AS t FROM v_docs)"
TOK = sql_tokens("lower(question)")


def keyword_cte(name: str, terms: str, score: str, k: int, where: str = "true", tag: str = "") -> str:
    tag = tag or name
    return f"""{tag}_q AS (SELECT query_id, {terms} AS terms FROM v_questions),
{tag}_s AS (SELECT query_id, doc_id AS hit_id, {score} AS score FROM {tag}_q, dl),
{name} AS (SELECT query_id, hit_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hit_id) AS rank FROM {tag}_s WHERE {where} QUALIFY rank <= {k})"""


IN_C = "len(list_filter(terms, lambda w: contains(c, w)))"
IN_T = "len(list_filter(terms, lambda w: contains(t, w)))"
REL_TERMS = rf"list_filter(list_distinct(regexp_extract_all(lower(question), '[\p{{L}}\p{{N}}_]+')), lambda w: NOT list_contains({sql_list(rt.RELEVANCE_STOP)}, w))"
LONG = f"list_filter({TOK}, lambda w: length(w) > 3)"
LIKE_TERMS = f"CASE WHEN len({LONG}) > 0 THEN ({LONG})[1:5] ELSE ({TOK})[1:3] END"


def relevance_cte(k: int, name: str = "h") -> str:
    return DL_CTE + ",\n" + keyword_cte(name, REL_TERMS, f"CAST({IN_C} + 2 * {IN_T} AS DOUBLE)", k)


@query("relevance_search", f"WITH {relevance_cte(3)} SELECT * FROM h", DQ)
def _(spark, root):
    return rt.relevance_search(docs(spark, root), questions(spark, root), 3)


@query("bag_of_words_search", f"WITH {DL_CTE}, {keyword_cte('h', TOK, f'CAST({IN_C} AS DOUBLE)', 3, 'score > 0')} SELECT * FROM h", DQ)
def _(spark, root):
    return rt.bag_search(docs(spark, root), questions(spark, root), 3)


@query("any_term_search", f"WITH {DL_CTE}, {keyword_cte('h', LIKE_TERMS, f'CASE WHEN {IN_C} > 0 THEN CAST(0.5 AS DOUBLE) ELSE 0 END', 5, 'score > 0')} SELECT * FROM h", DQ)
def _(spark, root):
    return rt.any_term_search(docs(spark, root), questions(spark, root), 5)


@query("fraction_search", f"WITH {DL_CTE}, {keyword_cte('h', LONG, r6(f'{IN_C} / greatest(len(terms), 1)'), 5, 'score > 0')} SELECT * FROM h", DQ)
def _(spark, root):
    return rt.fraction_search(docs(spark, root), questions(spark, root), 5)


# ---- combination

HYB_TERMS = f"list_filter(list_distinct({TOK}), lambda w: NOT list_contains({sql_list(rt.HYBRID_STOP)}, w))"


@query("hybrid_search", f"""WITH {vector_cte('w', 10, 'AND vec_id IN (SELECT doc_id FROM v_docs)')},
s AS (SELECT w.query_id, hit_id, score AS semantic_score,
  CASE WHEN len(terms) > 0 THEN len(list_filter(terms, lambda x: contains(lower(content), x))) / CAST(len(terms) AS DOUBLE) ELSE 0 END AS kw
  FROM w JOIN v_docs ON doc_id = hit_id JOIN (SELECT query_id, {HYB_TERMS} AS terms FROM v_question_vectors) t ON t.query_id = w.query_id)
SELECT query_id, hit_id, semantic_score, {r6("kw")} AS keyword_score, {r6("0.7::DOUBLE * semantic_score + 0.3::DOUBLE * kw")} AS combined_score,
  row_number() OVER (PARTITION BY query_id ORDER BY {r6("0.7::DOUBLE * semantic_score + 0.3::DOUBLE * kw")} DESC, hit_id) AS rank
FROM s QUALIFY rank <= 5""", ("v_docs", "v_question_vectors"))
def _(spark, root):
    return rt.hybrid_search(vectors(spark, root), question_vectors(spark, root), docs(spark, root), 5)


# Best matches of random unit vectors lie near 0.35, so this floor leaves some questions to the fallback.
VECTOR_FLOOR = 0.36


@query("retrieval_cascade", f"""WITH {vector_cte('v', 5, f'AND {r6("list_cosine_similarity(query_vec, CAST(embedding AS DOUBLE[]))")} >= {VECTOR_FLOOR}')}, {DL_CTE},
{keyword_cte('kw', LONG, r6(f'{IN_C} / greatest(len(terms), 1)'), 5, 'score > 0')},
b AS (SELECT query_id, hit_id, score, rank, 'vector' AS source FROM v UNION ALL
  SELECT query_id, hit_id, score, rank, 'keyword' FROM kw ANTI JOIN v USING (query_id))
SELECT q.query_id, hit_id, score, rank, coalesce(source, 'none') AS source FROM v_questions q LEFT JOIN b USING (query_id)""", DQ + VQ)
def _(spark, root):
    vec = rt.vector_search(vectors(spark, root), qvec(spark, root), 5, floor=VECTOR_FLOOR)
    kw = rt.fraction_search(docs(spark, root), questions(spark, root), 5)
    return rt.cascade_search(questions(spark, root), vec, kw)


# Words of the invented corpus stand in for the English marker words.
ADAPTIVE_WORDS = {"troubleshooting": ("with the", "lebr", "ción de"), "specific": ("that", "der", "elle de"), "broad": ("of the", "and", "las")}


def _any_sql(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


@query("adaptive_parameters", f"""WITH t AS (SELECT conv_id, turn, CASE WHEN {_any_sql('lower(text)', ADAPTIVE_WORDS['troubleshooting'])} THEN 'troubleshooting'
  WHEN {_any_sql('lower(text)', ADAPTIVE_WORDS['specific'])} THEN 'specific' WHEN {_any_sql('lower(text)', ADAPTIVE_WORDS['broad'])} THEN 'broad' ELSE 'default' END AS query_type FROM v_prompts)
SELECT conv_id, turn, query_type, CAST(CASE query_type WHEN 'troubleshooting' THEN 7 WHEN 'specific' THEN 3 ELSE 5 END AS INT) AS top_k,
  CAST(CASE query_type WHEN 'troubleshooting' THEN 5000 WHEN 'specific' THEN 2000 WHEN 'broad' THEN 4000 ELSE 3000 END AS INT) AS max_context FROM t""", ("v_prompts",))
def _(spark, root):
    return rt.adaptive_parameters(prompts(spark, root), "text", ADAPTIVE_WORDS).drop("text")


def context_cte(hits: str, limit: str = "4000", keys: str = "query_id", name: str = "ctx") -> str:
    return f"""{name}_p AS (SELECT h.*, '[Document ' || rank || ': ' || title || ']' || chr(10) || content AS passage FROM {hits} h JOIN v_docs ON doc_id = hit_id),
{name}_b AS (SELECT *, CAST({limit} - coalesce(sum(length(passage)) OVER (PARTITION BY {keys} ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS room FROM {name}_p),
{name}_k AS (SELECT *, CASE WHEN length(passage) <= room THEN passage WHEN room > 100 THEN substring(passage, 1, room) || '...' END AS kept FROM {name}_b),
{name} AS (SELECT {keys}, coalesce(string_agg(kept, chr(10) || chr(10) ORDER BY rank), '') AS context, count(kept) AS passages FROM {name}_k GROUP BY {keys})"""


def context_hits(spark, root, k):
    d = docs(spark, root)
    return rt.with_text(rt.relevance_search(d, questions(spark, root), k), d, "title", "content")


@query("context_assembly", f"WITH {relevance_cte(5)}, {context_cte('h')} SELECT * FROM ctx", DQ)
def _(spark, root):
    return rt.assemble_context(context_hits(spark, root, 5), 4000)


@query("context_config_sweep", f"""WITH {relevance_cte(8)},
cf AS (SELECT unnest([3, 5, 8]) AS top_k, unnest([2000, 4000, 6000]) AS max_chars),
hc AS (SELECT h.*, top_k, max_chars FROM h, cf WHERE rank <= top_k),
{context_cte('hc', 'max_chars', 'query_id, top_k, max_chars')}
SELECT CAST(top_k AS INT) AS top_k, CAST(max_chars AS INT) AS max_chars, count(*) AS queries, {r6('avg(passages)')} AS avg_passages,
  {r6('avg(length(context))')} AS avg_chars, CAST(sum(len({sql_tokens('context')})) AS BIGINT) AS tokens FROM ctx GROUP BY ALL""", DQ)
def _(spark, root):
    return rounded(config_contexts(spark, root).groupBy("top_k", "max_chars").agg(
        F.count(F.lit(1)).alias("queries"), F.avg("passages").alias("avg_passages"),
        F.avg(F.length("context")).alias("avg_chars"), F.sum(an.tx.word_count(F.col("context"))).alias("tokens"),
    ))


def config_contexts(spark, root):
    return rt.config_sweep(context_hits(spark, root, 8))


@query("conflicting_hits", f"""WITH {relevance_cte(5)},
t AS (SELECT query_id, hit_id, content, list_distinct({sql_tokens('lower(content)')}) AS w FROM h JOIN v_docs ON doc_id = hit_id),
p AS (SELECT a.query_id, a.hit_id AS first_id, b.hit_id AS second_id, len(list_intersect(a.w, b.w)) AS i, len(a.w) + len(b.w) AS u
  FROM t a JOIN t b ON a.query_id = b.query_id AND a.hit_id < b.hit_id WHERE a.content <> b.content)
SELECT query_id, first_id, second_id, {r6('i / CAST(u - i AS DOUBLE)')} AS similarity FROM p WHERE i / CAST(u - i AS DOUBLE) >= 0.3""", DQ)
def _(spark, root):
    return rounded(rt.conflict_pairs(context_hits(spark, root, 5), 0.3))


# ---- measures

@query("retrieval_measures", f"""WITH {vector_cte('h', 5)},
p AS (SELECT query_id, count(*) AS n, count(*) FILTER (label = category) AS r, min(rank) FILTER (label = category) AS f FROM h GROUP BY query_id)
SELECT count(*) AS queries, {r6("count(*) FILTER (coalesce(r, 0) > 0) / CAST(count(*) AS DOUBLE)")} AS hit_rate,
  {r6("avg(coalesce(r / CAST(n AS DOUBLE), 0))")} AS mean_precision, {r6("coalesce(sum(1.0::DOUBLE / f), 0) / count(*)")} AS mrr
FROM v_question_vectors LEFT JOIN p USING (query_id)""", VQ)
def _(spark, root):
    return rounded(rt.retrieval_measures(query_relevance(spark, root)))


def query_relevance(spark, root):
    q = qvec(spark, root)
    found = rt.vector_search(vectors(spark, root), q, 5)
    cats = vectors(spark, root).select(F.col("vec_id").alias("hit_id"), F.col("category").alias("label"))
    judged = found.join(cats, "hit_id").join(q.select("query_id", "category"), "query_id").withColumn("relevant", F.col("label") == F.col("category"))
    return rt.per_query_relevance(judged, q)


@query("query_relevance", f"""WITH {vector_cte('h', 5)},
p AS (SELECT query_id, count(*) AS n, count(*) FILTER (label = category) AS r, min(rank) FILTER (label = category) AS f FROM h GROUP BY query_id)
SELECT query_id, coalesce(r, 0) > 0 AS hit, {r6("coalesce(r / CAST(n AS DOUBLE), 0)")} AS precision_score, f AS first_rank
FROM v_question_vectors LEFT JOIN p USING (query_id)""", VQ)
def _(spark, root):
    return rounded(query_relevance(spark, root))


@query("retrieval_diagnosis", f"""WITH {DL_CTE}, {keyword_cte('h', LONG, r6(f'{IN_C} / greatest(len(terms), 1)'), 5, 'score >= 0.5')},
p AS (SELECT query_id, count(hit_id) AS n FROM v_questions LEFT JOIN h USING (query_id) GROUP BY query_id)
SELECT {r6('avg(n)')} AS avg_results_per_query, count(*) AS total_queries, 'retrieval' AS check,
  CASE WHEN avg(n) < 2 THEN 'LOW_RETRIEVAL_COUNT' ELSE '' END AS issues, CASE WHEN avg(n) < 2 THEN 'ISSUES_FOUND' ELSE 'HEALTHY' END AS status FROM p""", DQ)
def _(spark, root):
    return rounded(mo.diagnose_retrieval(results_per_query(spark, root)))


def results_per_query(spark, root):
    strong = rt.fraction_search(docs(spark, root), questions(spark, root), 5).where(F.col("score") >= 0.5)
    return questions(spark, root).select("query_id").join(strong, "query_id", "left").groupBy("query_id").agg(F.count("hit_id").alias("num_results"))


# ---- answers

PROMPT_SQL = "'Context:' || chr(10) || coalesce(context, '') || chr(10) || chr(10) || 'Question: ' || question || chr(10) || chr(10) || 'Answer: '"
ANSWER_SQL = "trim(split_part(trim(context, ' ' || chr(9) || chr(10) || chr(13) || chr(12)), '.', 1), ' ' || chr(9) || chr(10) || chr(13) || chr(12)) || '.'"
MAX_TOKENS = 700
N_SYSTEM = len(an.SYSTEM_PROMPT.split())
ANSWER_CTE = f"""{relevance_cte(3)}, {context_cte('h')},
pr AS (SELECT q.query_id, question, context, passages, {PROMPT_SQL} AS prompt FROM v_questions q LEFT JOIN ctx USING (query_id)),
wi AS (SELECT *, len({sql_tokens('prompt')}) + {N_SYSTEM} AS window_tokens FROM pr),
aw AS (SELECT *, window_tokens < {MAX_TOKENS} AS fits, CASE WHEN window_tokens < {MAX_TOKENS} THEN {ANSWER_SQL} END AS answer FROM wi)"""


def contexts(spark, root):
    return rt.assemble_context(context_hits(spark, root, 3), 4000)


def answered(spark, root):
    return an.answer_batch(questions(spark, root), contexts(spark, root), MAX_TOKENS)


@query("prompt_rendering", f"WITH {ANSWER_CTE} SELECT query_id, prompt FROM aw", DQ)
def _(spark, root):
    return answered(spark, root).select("query_id", "prompt")


@query("extractive_answers", f"""WITH t AS (SELECT doc_id, content AS context FROM v_docs)
  SELECT doc_id, {ANSWER_SQL} AS answer, len({sql_tokens('context')}) AS prompt_tokens, len({sql_tokens(ANSWER_SQL)}) AS completion_tokens,
  len({sql_tokens('context')}) + len({sql_tokens(ANSWER_SQL)}) AS total_tokens, {r6(f"(len({sql_tokens('context')}) + len({sql_tokens(ANSWER_SQL)})) * 0.00002::DOUBLE")} AS cost_usd FROM t""", ("v_docs",))
def _(spark, root):
    d = docs(spark, root).select("doc_id", F.col("content").alias("prompt"), an.extractive_answer(F.col("content")).alias("answer"))
    return rounded(an.token_columns(d).drop("prompt"))


ROUTES = (
    (("thatnd", "with anat"), ("that",), "Based on the documentation"),
    (("erent", "reas"), ("with", "days"), "Based on the policy"),
    (("ation", "there"), ("ation", "MFA"), "Based on the access control policy"),
)


def _route_sql(i: int) -> str:
    asks, has, _ = ROUTES[i]
    return f"({_any_sql('lower(question)', asks)} AND {_any_sql('lower(content)', has)})"


@query("routed_answers", f"""WITH {relevance_cte(5)},
r AS (SELECT h.query_id, rank, content, CASE {' '.join(f"WHEN {_route_sql(i)} THEN {i}" for i in range(3))} END AS route FROM h JOIN v_docs ON doc_id = hit_id JOIN v_questions q ON q.query_id = h.query_id),
b AS (SELECT query_id, route, content FROM r WHERE route IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY route, rank) = 1),
f AS (SELECT query_id, string_agg(content, ' ' ORDER BY rank) AS two FROM r WHERE rank <= 2 GROUP BY query_id)
SELECT q.query_id, CAST(route AS INT) AS route, CASE WHEN route IS NOT NULL THEN (['{ROUTES[0][2]}', '{ROUTES[1][2]}', '{ROUTES[2][2]}'])[route + 1] || ': ' || content
  ELSE 'Based on the available information: ' || substring(two, 1, 300) || '...' END AS answer
FROM v_questions q LEFT JOIN b USING (query_id) LEFT JOIN f USING (query_id)""", DQ)
def _(spark, root):
    return an.routed_answer(context_hits(spark, root, 5), questions(spark, root), ROUTES)


@query("context_window_check", f"WITH {ANSWER_CTE} SELECT query_id, window_tokens, fits, {r6(f'window_tokens / CAST({MAX_TOKENS} AS DOUBLE)')} AS utilization FROM aw", DQ)
def _(spark, root):
    return rounded(answered(spark, root).select("query_id", "window_tokens", "fits", "utilization"))


@query("answer_batch", f"""WITH {ANSWER_CTE} SELECT query_id, passages, answer, CASE WHEN NOT fits THEN 'Context window overflow' END AS error,
  len({sql_tokens('prompt')}) AS prompt_tokens, len({sql_tokens('answer')}) AS completion_tokens, len({sql_tokens('prompt')}) + len({sql_tokens('answer')}) AS total_tokens,
  {r6(f"(len({sql_tokens('prompt')}) + len({sql_tokens('answer')})) * 0.00002::DOUBLE")} AS cost_usd FROM aw""", DQ)
def _(spark, root):
    return rounded(answered(spark, root).select("query_id", "passages", "answer", "error", "prompt_tokens", "completion_tokens", "total_tokens", "cost_usd"))


_KEY = "md5(lower(trim(content, ' ' || chr(9) || chr(10) || chr(13) || chr(12))))"


@query("response_reuse", f"""SELECT doc_id, {_KEY} AS prompt_key, min(doc_id) OVER (PARTITION BY {_KEY}) AS answered_by,
  row_number() OVER (PARTITION BY {_KEY} ORDER BY doc_id) > 1 AS is_hit FROM v_docs""", ("v_docs",))
def _(spark, root):
    return an.response_reuse(docs(spark, root), "doc_id", "content")


@query("response_reuse_summary", f"""SELECT count(DISTINCT {_KEY}) AS misses, count(*) - count(DISTINCT {_KEY}) AS hits,
  {r6(f"(count(*) - count(DISTINCT {_KEY})) * 100.0 / count(*)")} AS hit_rate FROM v_docs""", ("v_docs",))
def _(spark, root):
    return rounded(an.reuse_summary(docs(spark, root), "content"))


@query("claim_triage", """SELECT claim_id, policy_id, active, CASE WHEN contains(lower(description), 'urgent') THEN 'collision'
  WHEN contains(lower(description), 'high') THEN 'vandalism' WHEN contains(lower(description), 'low') THEN 'weather' ELSE 'other' END AS incident,
  CASE WHEN estimated_cost <= 100000 THEN 'low' WHEN estimated_cost <= 200000 THEN 'medium' ELSE 'high' END AS severity,
  CASE WHEN NOT active THEN 'Reject' WHEN estimated_cost > 200000 THEN 'Manual Review' ELSE 'Auto-Approve' END AS decision,
  CASE WHEN active AND estimated_cost > 200000 THEN 'PENDING' ELSE 'CLOSED' END AS final_status FROM v_claims""", ("v_claims",))
def _(spark, root):
    words = {"weather": ("low",), "vandalism": ("high",), "collision": ("urgent",)}
    return an.triage_claims(claims(spark, root), policies(spark, root), 200000.0, (100000.0, 200000.0), words)


@query("context_window_diagnosis", f"""WITH {ANSWER_CTE}, m AS (SELECT avg(window_tokens / CAST({MAX_TOKENS} AS DOUBLE)) AS a, max(window_tokens / CAST({MAX_TOKENS} AS DOUBLE)) AS x,
  count(*) FILTER (NOT fits) AS o FROM aw),
i AS (SELECT *, concat_ws(', ', CASE WHEN x > 0.9 THEN 'CONTEXT_WINDOW_NEAR_LIMIT' END, CASE WHEN a > 0.7 THEN 'HIGH_AVERAGE_UTILIZATION' END,
  CASE WHEN o > 0 THEN 'CONTEXT_OVERFLOWS: ' || o END) AS issues FROM m)
SELECT {r6('a')} AS avg_utilization, {r6('x')} AS max_utilization, o AS overflow_count, 'context_window' AS check, issues,
  CASE WHEN issues = '' THEN 'HEALTHY' ELSE 'ISSUES_FOUND' END AS status FROM i""", DQ)
def _(spark, root):
    return rounded(mo.diagnose_context_window(answered(spark, root)))


@query("diagnosis_report", f"""WITH {DIAG_LATENCY_CTE}, {ANSWER_CTE}, {keyword_cte('kh', LONG, r6(f'{IN_C} / greatest(len(terms), 1)'), 5, 'score >= 0.5')},
p AS (SELECT query_id, count(hit_id) AS n FROM v_questions LEFT JOIN kh USING (query_id) GROUP BY query_id),
m AS (SELECT avg(window_tokens / CAST({MAX_TOKENS} AS DOUBLE)) AS a, max(window_tokens / CAST({MAX_TOKENS} AS DOUBLE)) AS x, count(*) FILTER (NOT fits) AS o FROM aw),
u AS (SELECT 'latency' AS "check", issues FROM lat UNION ALL SELECT 'retrieval', CASE WHEN avg(n) < 2 THEN 'LOW_RETRIEVAL_COUNT' ELSE '' END FROM p
  UNION ALL SELECT 'context_window', concat_ws(', ', CASE WHEN x > 0.9 THEN 'CONTEXT_WINDOW_NEAR_LIMIT' END, CASE WHEN a > 0.7 THEN 'HIGH_AVERAGE_UTILIZATION' END,
  CASE WHEN o > 0 THEN 'CONTEXT_OVERFLOWS: ' || o END) FROM m)
SELECT "check", issues, CASE WHEN issues = '' THEN 'HEALTHY' ELSE 'ISSUES_FOUND' END AS status FROM u""", DQ + ("v_traffic",))
def _(spark, root):
    return mo.diagnosis_report(
        mo.diagnose_latency(traffic(spark, root), SLA, HIGH),
        mo.diagnose_retrieval(results_per_query(spark, root)),
        mo.diagnose_context_window(answered(spark, root)),
    )
