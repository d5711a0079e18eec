"""Guardrail and PII queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import patterns as pt
from corpusloom.functions import text as tx
from corpusloom.operators import guardrails as gd
from corpusloom.plans.corpus_queries import sql_squeeze, sql_tokens
from corpusloom.plans.registry import query
from corpusloom.plans.retrieval_queries import DL_CTE, IN_C, TOK, keyword_cte, sql_list
from corpusloom.operators import retrieval as rt
from corpusloom.plans.shared import r6, rounded
from corpusloom.sources.bindings import docs, prompts, questions, traffic
from corpusloom.sources.tables import table

D = ("v_docs",)
# Words of the invented corpus that stand in for the English lists.
INSULTS = ("clown", "idiot", "moron", "scum", "trash", "loser", "stupid", "disgusting")
PROHIBITED = pt.PROHIBITED_PATTERNS + (r"with\s+that",)
RISKS = {**pt.RISK_PATTERNS, "sensitive_content": pt.RISK_PATTERNS["sensitive_content"] + INSULTS, "jailbreak_attempt": pt.RISK_PATTERNS["jailbreak_attempt"] + (r"with\s+that\s",)}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_sql(c: str, patterns) -> str:
    return f"regexp_matches({c}, {q('(?i)(?:' + '|'.join(f'(?:{p})' for p in patterns) + ')')})"


def special_sql(c: str) -> str:
    return rf"length(regexp_replace({c}, '[\p{{L}}\p{{N}}\p{{Z}} \t\n\r\f]', '', 'g')) / CAST(length({c}) AS DOUBLE)"


def flag_sql(c: str, patterns=PROHIBITED) -> str:
    which = " ".join(f"WHEN {any_sql(c, [p])} THEN {q('PROHIBITED_PATTERN: ' + p)}" for p in patterns)
    return f"CASE WHEN length({c}) < 10 THEN 'TOO_SHORT' WHEN length({c}) > 5000 THEN 'TOO_LONG' {which} WHEN {special_sql(c)} > 0.3 THEN 'EXCESSIVE_SPECIAL_CHARS' ELSE 'PASSED' END"


# RE2 has no lookahead; the plain form finds the same in this corpus, which holds no dashed number of that shape.
SQL_A = {t: (r"\b\d{3}-\d{2}-\d{4}\b" if t == "US_SSN" else p, tok) for t, (p, tok) in pt.PII_A.items()}
SQL_B = {t: (p if t in pt.CASED_TYPES else "(?i)" + p, tok) for t, (p, tok) in pt.PII_B.items()}


def mark(c: str) -> str:
    """RE2's word boundary is ASCII only. Accented letters get underscores around them, which are word
    characters, so that a boundary next to them fails as it does under Unicode rules."""
    return rf"regexp_replace({c}, '([\x{{C0}}-\x{{24F}}])', '_\1_', 'g')"


def unmark(c: str) -> str:
    return rf"regexp_replace({c}, '_([\x{{C0}}-\x{{24F}}])_', '\1', 'g')"


def count_sql(c: str, profile=SQL_A) -> str:
    return " + ".join(f"len(regexp_extract_all({mark(c)}, {q(p)}))" for p, _ in profile.values())


def mask_sql(c: str, profile=SQL_A) -> str:
    c = mark(c)
    for p, tok in profile.values():
        c = f"regexp_replace({c}, {q(p)}, {q(tok)}, 'g')"
    return unmark(c)


def substitute_sql(c: str) -> str:
    c = mark(c)
    for patterns, tok in pt.RESTRICTED.values():
        for p in patterns:
            c = f"regexp_replace({c}, {q('(?i)' + p)}, {q(tok)}, 'g')"
    return unmark(c)


@query("prompt_validation", f"SELECT doc_id, {flag_sql('content')} = 'PASSED' AS valid, {flag_sql('content')} AS flag, length(substring(content, 1, 5000)) AS kept_chars FROM v_docs", D)
def _(spark, root):
    v = gd.validate_prompt(F.col("content"), PROHIBITED)
    return docs(spark, root).select("doc_id", v.alias("v")).select("doc_id", "v.valid", "v.flag", F.length("v.text").cast("bigint").alias("kept_chars"))


RISK_CTE = f"""rk AS (SELECT doc_id, content, list_sort(list_filter([{', '.join(f"CASE WHEN {any_sql('content', p)} THEN '{r}' END" for r, p in RISKS.items())},
  CASE WHEN {count_sql('content')} > 0 THEN 'pii_exposure' END, CASE WHEN len({sql_tokens('content')}) > 4000 THEN 'token_waste' END], lambda x: x IS NOT NULL)) AS risks FROM v_docs)"""


def _action_sql() -> str:
    parts = []
    for a in pt.ACTION_NOTES:
        rs = [r for r, acts in pt.RISK_ACTIONS.items() if a in acts]
        parts.append(f"CASE WHEN list_has_any(risks, {sql_list(rs)}) THEN '{a}' END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


ACTION_CTE = RISK_CTE + f", ac AS (SELECT *, {_action_sql()} AS actions FROM rk)"


def risks(spark, root):
    c = F.col("content")
    r = gd.detect_risks(c, gd.pii_count(c), tx.word_count(c), RISKS)
    return docs(spark, root).select("doc_id", "content", r.alias("risks"))


@query("risk_detection", f"WITH {RISK_CTE} SELECT doc_id, array_to_string(risks, ',') AS risks FROM rk", D)
def _(spark, root):
    return risks(spark, root).select("doc_id", F.array_join("risks", ",").alias("risks"))


@query("action_selection", f"WITH {ACTION_CTE} SELECT array_to_string(risks, ',') AS risks, array_to_string(actions, ',') AS actions, count(*) AS prompts FROM ac GROUP BY ALL", D)
def _(spark, root):
    a = risks(spark, root).select("risks", gd.select_actions(F.col("risks")).alias("actions"))
    return a.groupBy(F.array_join("risks", ",").alias("risks"), F.array_join("actions", ",").alias("actions")).agg(F.count(F.lit(1)).alias("prompts"))


@query("action_application", f"""WITH {ACTION_CTE},
m AS (SELECT *, CASE WHEN list_contains(actions, 'mask') THEN {mask_sql('content')} ELSE content END AS t1 FROM ac),
f AS (SELECT *, CASE WHEN list_contains(actions, 'filter') THEN {substitute_sql('t1')} ELSE t1 END AS t2 FROM m),
c AS (SELECT *, CASE WHEN list_contains(actions, 'compress') THEN {sql_squeeze('t2')} ELSE t2 END AS t3 FROM f)
SELECT doc_id, NOT list_contains(actions, 'block') AS allowed, md5(CASE WHEN list_contains(actions, 'block') THEN '' ELSE t3 END) AS text_digest,
  CASE WHEN list_contains(actions, 'block') THEN '{pt.ACTION_NOTES["block"]}' ELSE concat_ws('; ', {', '.join(f"CASE WHEN list_contains(actions, '{a}') THEN '{n}' END" for a, n in pt.ACTION_NOTES.items())}) END AS notes FROM c""", D)
def _(spark, root):
    a = gd.apply_actions(risks(spark, root).withColumn("actions", gd.select_actions(F.col("risks"))), "content", "actions")
    return a.select("doc_id", "allowed", F.md5("processed").alias("text_digest"), F.array_join("notes", "; ").alias("notes"))


def _span_sql(profile) -> str:
    parts = " UNION ALL ".join(f"SELECT doc_id, '{t}' AS entity_type, regexp_extract_all({mark('content')}, {q(p)}) AS f FROM v_docs" for t, (p, _) in profile.items())
    return f"SELECT doc_id, entity_type, CAST(unnest(range(len(f))) AS INT) AS ordinal, unnest(f) AS entity FROM ({parts})"


@query("pii_spans", _span_sql(SQL_A), D)
def _(spark, root):
    return gd.pii_spans(docs(spark, root), ["doc_id"], "content")


@query("pii_spans_profile_b", _span_sql(SQL_B), D)
def _(spark, root):
    return gd.pii_spans(docs(spark, root), ["doc_id"], "content", pt.PII_B)


def _offset_sql(profile) -> str:
    return " UNION ALL ".join(
        f"""SELECT doc_id, '{t}' AS entity_type, CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS INT) AS start,
  f[i] AS entity FROM (SELECT doc_id, regexp_extract_all({mark('content')}, {q(p)}) AS f, list_transform(regexp_split_to_array({mark('content')}, {q(p)}), lambda y: {unmark('y')}) AS s FROM v_docs), unnest(range(1, len(f) + 1)) u(i)"""
        for t, (p, _) in profile.items()
    )


@query("pii_offsets", f"SELECT doc_id, entity_type, start, CAST(start + length(entity) AS INT) AS \"end\", entity FROM ({_offset_sql(SQL_A)})", D)
def _(spark, root):
    return gd.pii_offsets(docs(spark, root), ["doc_id"], "content")


@query("pii_masking_replace", f"SELECT doc_id, {mask_sql('content')} AS masked FROM v_docs", D)
def _(spark, root):
    return docs(spark, root).select("doc_id", gd.mask_replace(F.col("content")).alias("masked"))


ALT = q("|".join(f"(?:{p})" for p, _ in SQL_A.values()))


def _rebuild_sql(masked: str) -> str:
    return f"""WITH p AS (SELECT doc_id, regexp_split_to_array({mark('content')}, {ALT}) AS s, regexp_extract_all({mark('content')}, {ALT}) AS f FROM v_docs)
  SELECT doc_id, {unmark("array_to_string(list_transform(list_zip(s, list_append(list_transform(f, lambda m: " + masked + "), '')), lambda z: z[1] || z[2]), '')")} AS masked FROM p"""


@query("pii_masking_hash", _rebuild_sql("substring(sha256(m), 1, 16)"), D)
def _(spark, root):
    return docs(spark, root).select("doc_id", gd.mask_matches(F.col("content"), "hash").alias("masked"))


@query("pii_masking_redact", _rebuild_sql("repeat('*', length(m))"), D)
def _(spark, root):
    return docs(spark, root).select("doc_id", gd.mask_matches(F.col("content"), "redact").alias("masked"))


@query("pii_statistics", f"""WITH c AS (SELECT {count_sql('content')} AS n FROM v_docs)
  SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total_entities, {r6('avg(n)')} AS avg_per_document, count(*) FILTER (n > 0) AS documents_with_pii FROM c""", D)
def _(spark, root):
    return rounded(gd.pii_statistics(docs(spark, root), "content"))


@query("pii_distribution", f"WITH s AS ({_span_sql(SQL_A)}) SELECT entity_type, count(*) AS entities, count(DISTINCT doc_id) AS documents FROM s GROUP BY 1", D)
def _(spark, root):
    return gd.pii_distribution(docs(spark, root), "content")


def _made_sql() -> str:
    parts = [
        f"list_transform(regexp_extract_all({mark('content')}, {q('(?i)' + p)}), lambda m: {q(cat + ': ')} || m || {q(' → ' + tok)})"
        for cat, (ps, tok) in pt.RESTRICTED.items() for p in ps
    ]
    return f"list_concat({', '.join(parts)})"


@query("compliant_retrieval", f"""WITH {DL_CTE}, {keyword_cte('h', TOK, f'CAST({IN_C} AS DOUBLE)', 3, 'score > 0')},
x AS (SELECT query_id, hit_id, rank, content, {_made_sql()} AS made FROM h JOIN v_docs ON doc_id = hit_id)
SELECT query_id, hit_id, rank, {substitute_sql('content')} AS compliant_content, array_to_string(made, '; ') AS substitutions, len(made) AS restricted_items,
  CASE WHEN len(made) > 0 THEN 'FILTERED' ELSE 'CLEAN' END AS compliance_status FROM x""", ("v_docs", "v_questions"))
def _(spark, root):
    d = docs(spark, root)
    hits = rt.with_text(rt.bag_search(d, questions(spark, root), 3), d, "content")
    return gd.compliant_documents(hits).drop("content", "score")


# A user of the data sends about two requests a day, so the windows are wider than a minute and an hour.
SIX_HOURS, DAY = 6 * gd.HOUR, 24 * gd.HOUR


@query("offered_load", f"""WITH w AS (SELECT request_id, user_id, total_tokens,
  count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {SIX_HOURS - 1} PRECEDING AND CURRENT ROW) - 1 AS requests_before,
  CAST(sum(total_tokens) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW) AS BIGINT) - total_tokens AS tokens_before FROM v_traffic)
SELECT request_id, user_id, requests_before, tokens_before, CASE WHEN requests_before >= 2 THEN 'RATE_LIMIT_EXCEEDED'
  WHEN tokens_before + total_tokens > 300 THEN 'TOKEN_LIMIT_EXCEEDED' ELSE 'ALLOWED' END AS rate_status FROM w""", ("v_traffic",))
def _(spark, root):
    log = traffic(spark, root).select("request_id", "user_id", "ts", "total_tokens")
    clock = F.unix_micros(F.col("ts").cast("timestamp"))
    return gd.offered_load(log, "user_id", clock, F.col("total_tokens"), None, SIX_HOURS, DAY, 2, 300).drop("ts", "total_tokens")


# The turn number is the clock of a conversation: one turn counts as one minute.
AUDIT_CTE = f"""va AS (SELECT conv_id, turn, text, {flag_sql('text')} AS flag, length(text) AS n FROM v_prompts),
ld AS (SELECT *, flag = 'PASSED' AS ok,
  sum(CASE WHEN flag = 'PASSED' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn * 60000000 RANGE BETWEEN {5 * gd.MINUTE - 1} PRECEDING AND CURRENT ROW) - CASE WHEN flag = 'PASSED' THEN 1 ELSE 0 END AS rb,
  sum(CASE WHEN flag = 'PASSED' THEN n ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn * 60000000 RANGE BETWEEN {60 * gd.MINUTE - 1} PRECEDING AND CURRENT ROW) - CASE WHEN flag = 'PASSED' THEN n ELSE 0 END AS tb FROM va),
rs AS (SELECT *, CASE WHEN rb >= 2 THEN 'RATE_LIMIT_EXCEEDED' WHEN tb + n > 1000 THEN 'TOKEN_LIMIT_EXCEEDED' ELSE 'ALLOWED' END AS rate FROM ld),
au AS (SELECT conv_id, turn, text, CASE WHEN ok AND rate = 'ALLOWED' THEN 'SUCCESS' ELSE 'BLOCKED' END AS status,
  CASE WHEN NOT ok THEN 'Invalid prompt' WHEN rate <> 'ALLOWED' THEN 'Rate limit exceeded' ELSE '' END AS reason,
  CASE WHEN NOT ok THEN flag WHEN rate <> 'ALLOWED' THEN rate ELSE 'PASSED' END AS flags,
  CASE WHEN ok AND rate = 'ALLOWED' THEN {count_sql('text')} END AS pii_detected, CASE WHEN ok AND rate = 'ALLOWED' THEN {mask_sql('text')} END AS masked_text FROM rs)"""


def audit(spark, root):
    p = prompts(spark, root)
    return gd.guardrail_audit(
        p, "conv_id", "text", (F.col("turn") * gd.MINUTE), F.length("text"), PROHIBITED,
        request_window=5 * gd.MINUTE, token_window=60 * gd.MINUTE, max_requests=2, max_tokens=1000,
    )


@query("guardrail_audit", f"WITH {AUDIT_CTE} SELECT conv_id, turn, status, reason, flags, pii_detected, masked_text FROM au", ("v_prompts",))
def _(spark, root):
    return audit(spark, root).drop("text")


@query("guardrail_metrics", f"""WITH {AUDIT_CTE}, m AS (SELECT avg(CASE WHEN status <> 'SUCCESS' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS b, coalesce(avg(pii_detected), 0) AS p, avg(length(text)) AS l FROM au),
r AS (SELECT 'guardrail_block_rate' AS metric_name, b AS metric_value, CAST(0.5 AS DOUBLE) AS threshold FROM m UNION ALL SELECT 'pii_detection_rate', p, 5 FROM m UNION ALL SELECT 'avg_prompt_length', l, 5000 FROM m)
SELECT metric_name, {r6('metric_value')} AS metric_value, threshold, CASE WHEN metric_value > threshold THEN 'ALERT' ELSE 'NORMAL' END AS status FROM r""", ("v_prompts",))
def _(spark, root):
    return rounded(gd.guardrail_metrics(audit(spark, root), "text"))


@query("guardrail_status_counts", f"WITH {AUDIT_CTE} SELECT status, reason, count(*) AS prompts FROM au GROUP BY ALL", ("v_prompts",))
def _(spark, root):
    return audit(spark, root).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("prompts"))


@query("role_filter", "SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant')")
def _(spark, root):
    return gd.role_filter(table(spark, root, "conversations"), "role", ["user", "assistant"]).select("conv_id", "turn", "role")


@query("content_filter_quality", f"""WITH s AS (SELECT {any_sql('text', INSULTS)} AS f, toxic = 1 AS t FROM documents JOIN labels USING (doc_id)),
c AS (SELECT count(*) FILTER (f AND t) AS true_pos, count(*) FILTER (f AND NOT t) AS false_pos, count(*) FILTER (NOT f AND t) AS false_neg, count(*) FILTER (NOT f AND NOT t) AS true_neg FROM s)
SELECT *, {r6('CASE WHEN true_pos + false_pos > 0 THEN true_pos / (true_pos + false_pos) ELSE 0 END')} AS precision_score,
  {r6('CASE WHEN true_pos + false_neg > 0 THEN true_pos / (true_pos + false_neg) ELSE 0 END')} AS recall_score FROM c""")
def _(spark, root):
    # Only ids and the flag are shuffled, never the text.
    flagged = docs(spark, root).select("doc_id", gd.any_pattern(F.col("content"), INSULTS).alias("flagged"))
    s = flagged.join(table(spark, root, "labels"), "doc_id")
    return rounded(gd.filter_quality(s, F.col("flagged"), F.col("toxic") == 1))
