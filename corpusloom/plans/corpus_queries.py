"""Sources, sinks, text cleaning and chunking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import chunking as ck
from corpusloom.plans.registry import query
from corpusloom.plans.shared import r6, rounded
from corpusloom.session import scratch_path
from corpusloom.sources import sinks
from corpusloom.sources.bindings import docs, prompts
from corpusloom.sources.change_feed import change_feed, write_digests
from corpusloom.sources.tables import table
from corpusloom.streaming.stateful import run_available

D = ("v_docs",)
WSQ = r"[ \t\n\r\f]"
TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"


def sql_tokens(c: str) -> str:
    return rf"regexp_extract_all({c}, '[^ \t\n\r\f]+')"


def sql_clean(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({c}, '\n+', chr(10), 'g'), '{WSQ}{{2,}}', ' ', 'g'), '(?i)page [0-9]+', '', 'g'), {TRIM})"


def sql_squeeze(c: str) -> str:
    return rf"trim(regexp_replace({c}, '{WSQ}+', ' ', 'g'), {TRIM})"


# ---- sources and sinks

@query("corpus_by_category", "SELECT category, count(*) AS documents, count(DISTINCT source) AS sources FROM v_docs GROUP BY category", D)
def _(spark, root):
    return docs(spark, root).groupBy("category").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("source").alias("sources"))


def _sql_html(c: str) -> str:
    for p in tx.HTML_BLOCKS:
        c = f"regexp_replace({c}, '{p}', ' ', 'g')"
    for e, ch in tx.HTML_ENTITIES:
        ch = ch.replace("'", "''")
        c = f"replace({c}, '{e}', '{ch}')"
    return sql_clean(c)


@query("page_text", f"SELECT page_id, url, {_sql_html('html')} AS content FROM pages")
def _(spark, root):
    return table(spark, root, "pages").select("page_id", "url", tx.html_to_text(F.col("html")).alias("content"))


@query("source_union", """
  SELECT 'policy' AS doc_type, 'documents-' || doc_id AS doc_key, split_part(text, chr(10), 1) AS title, lang AS category, length(text) AS char_count FROM documents
  UNION ALL SELECT 'report', 'pages-' || page_id, url, 'general', length(html) FROM pages
  UNION ALL SELECT 'procedure', 'benchmark-' || item_id, 'benchmark-' || item_id, 'general', length(text) FROM benchmark""")
def _(spark, root):
    d = docs(spark, root).select(F.concat_ws("-", F.lit("documents"), "doc_id").alias("doc_key"), "title", "category", "content")
    p = table(spark, root, "pages").select(F.concat_ws("-", F.lit("pages"), "page_id").alias("doc_key"), "url", F.col("html").alias("content"))
    b = table(spark, root, "benchmark").select(F.concat_ws("-", F.lit("benchmark"), "item_id").alias("doc_key"), F.col("text").alias("content"))
    return sinks.tagged_union([("policy", d), ("report", p), ("procedure", b)]).select(
        "doc_type", "doc_key",
        F.coalesce("title", "url", "doc_key").alias("title"),
        F.coalesce("category", F.lit("general")).alias("category"),
        F.length("content").cast("bigint").alias("char_count"),
    )


@query("ingest_stamp", "SELECT doc_id, category, 'pending' AS embedding_status, true AS stamped, true AS unindexed FROM v_docs", D)
def _(spark, root):
    return sinks.ingest_stamp(docs(spark, root)).select(
        "doc_id", "category", "embedding_status", F.col("created_at").isNotNull().alias("stamped"), F.col("indexed_at").isNull().alias("unindexed")
    )


@query("write_round_trip", "SELECT category, 2 * count(*) AS row_count, CAST(2 * sum(length(content)) AS BIGINT) AS chars FROM v_docs GROUP BY category", D)
def _(spark, root):
    path = scratch_path(spark, "documents")
    d = docs(spark, root)
    for mode in ("overwrite", "overwrite", "append"):
        back = sinks.write_table(d, path, mode, partition_by=["category"])
    return back.groupBy("category").agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.length("content")).alias("chars"))


@query("snapshot_manifest", "SELECT 'v1' AS version, count(*) AS row_count, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM v_docs", D)
def _(spark, root):
    return sinks.write_snapshot(docs(spark, root), scratch_path(spark, "snapshot"), "v1", "category")


SYNC_CTE = f"""old AS (SELECT d.doc_id, d.text AS content FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id),
new AS (SELECT d.doc_id, {sql_clean("d.text")} AS content FROM documents d ANTI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) t ON d.doc_id = t.doc_id)"""


def sync_inputs(spark, root):
    """Indexed: labelled documents as they came. Current: cleaned documents without those labelled toxic."""
    d, labels = table(spark, root, "documents"), table(spark, root, "labels")
    indexed = d.join(labels, "doc_id", "left_semi").select("doc_id", F.col("text").alias("content"))
    toxic = labels.where(F.col("toxic") == 1).select("doc_id")
    current = d.join(toxic, "doc_id", "left_anti").select("doc_id", tx.clean_text(F.col("text")).alias("content"))
    return current, indexed


@query("index_changes", f"""WITH {SYNC_CTE}
  SELECT doc_id, CASE WHEN o.content IS NULL THEN 'insert' WHEN n.content IS NULL THEN 'delete' ELSE 'update' END AS action
  FROM old o FULL JOIN new n USING (doc_id) WHERE o.content IS DISTINCT FROM n.content""")
def _(spark, root):
    return sinks.index_changes(*sync_inputs(spark, root), key="doc_id", content="content")


def snapshot_digests(spark, root):
    """Two snapshots, the indexed documents and the current ones, as digests."""
    current, indexed = sync_inputs(spark, root)
    path = scratch_path(spark, "snapshots")
    for version, docs_ in enumerate((indexed, current), 1):
        write_digests(docs_, path, version, "doc_id", "content")
    return path


FEED = f"""WITH {SYNC_CTE} SELECT doc_id, 'insert' AS action, CAST(1 AS BIGINT) AS version FROM old UNION ALL
  SELECT doc_id, CASE WHEN o.content IS NULL THEN 'insert' WHEN n.content IS NULL THEN 'delete' ELSE 'update' END AS action, 2
  FROM old o FULL JOIN new n USING (doc_id) WHERE o.content IS DISTINCT FROM n.content"""


@query("change_feed", FEED)
def _(spark, root):
    return change_feed(spark, snapshot_digests(spark, root)).withColumnRenamed("key", "doc_id")


@query("change_feed_stream", FEED)
def _(spark, root):
    stream = change_feed(spark, snapshot_digests(spark, root), stream=True)
    return run_available(stream, "change-feed").withColumnRenamed("key", "doc_id")


@query("index_after_sync", f"WITH {SYNC_CTE} SELECT doc_id, md5(content) AS digest FROM new")
def _(spark, root):
    current, indexed = sync_inputs(spark, root)
    changes = sinks.index_changes(current, indexed, "doc_id", "content")
    return sinks.apply_changes(indexed, current, changes, "doc_id").select("doc_id", F.md5("content").alias("digest"))


@query("json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(spark, root):
    return table(spark, root, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


# ---- text cleaning and statistics

@query("clean_text", f"SELECT doc_id, {sql_clean('content')} AS content FROM v_docs", D)
def _(spark, root):
    return docs(spark, root).select("doc_id", tx.clean_text(F.col("content")).alias("content"))


@query("document_stats", f"SELECT doc_id, length(content) AS char_count, len({sql_tokens('content')}) AS word_count FROM v_docs", D)
def _(spark, root):
    return docs(spark, root).select("doc_id", F.length("content").cast("bigint").alias("char_count"), tx.word_count(F.col("content")).alias("word_count"))


@query("normalised_prompts", f"SELECT conv_id, turn, lower({sql_squeeze('text')}) AS prompt, md5(lower({sql_squeeze('text')})) AS prompt_key FROM v_prompts", ("v_prompts",))
def _(spark, root):
    p = tx.normalise_query(F.col("text"))
    return prompts(spark, root).select("conv_id", "turn", p.alias("prompt"), F.md5(p).alias("prompt_key"))


@query("token_estimates", f"SELECT conv_id, turn, role, len({sql_tokens('text')}) AS tokens, 2 * len({sql_tokens('text')}) AS expected_tokens FROM conversations")
def _(spark, root):
    n = tx.word_count(F.col("text"))
    return table(spark, root, "conversations").select("conv_id", "turn", "role", n.alias("tokens"), (2 * n).alias("expected_tokens"))


@query("effective_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS effective_date, CAST(NULL AS DATE) AS from_bad_text FROM orders")
def _(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey",
        F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("effective_date"),
        F.try_to_date(F.col("o_orderpriority"), "yyyy-MM-dd").alias("from_bad_text"),
    )


@query("context_truncation", rf"""WITH t AS (SELECT doc_id, content, {sql_tokens('content')} AS w FROM v_docs)
  SELECT doc_id, CASE WHEN len(w) > 150 THEN array_to_string(w[1:150], ' ') || '...' ELSE content END AS context, len(w) > 150 AS truncated FROM t""", D)
def _(spark, root):
    context, cut = tx.first_words(F.col("content"), int(200 * 0.75))
    return docs(spark, root).select("doc_id", context.alias("context"), cut.alias("truncated"))


@query("prompt_compression", rf"""SELECT conv_id, turn, {sql_squeeze('text')} AS compressed, length(text) AS chars_before,
  length({sql_squeeze('text')}) AS chars_after, length(text) - length({sql_squeeze('text')}) AS chars_saved,
  len(regexp_split_to_array(text, '{WSQ}')) - len({sql_tokens('text')}) AS blank_tokens_saved FROM conversations""")
def _(spark, root):
    t = F.col("text")
    small = tx.squeeze(t)
    return table(spark, root, "conversations").select(
        "conv_id", "turn", small.alias("compressed"),
        F.length(t).cast("bigint").alias("chars_before"), F.length(small).cast("bigint").alias("chars_after"),
        (F.length(t) - F.length(small)).cast("bigint").alias("chars_saved"),
        (F.regexp_count(t, F.lit(tx.WS)) + 1 - tx.word_count(t)).cast("bigint").alias("blank_tokens_saved"),
    )


@query("extractive_truth", """WITH s AS (SELECT doc_id, content, string_split(content, '. ') AS p FROM v_docs)
  SELECT doc_id, p[1] || '.' AS simple, CASE WHEN len(p) >= 2 THEN p[1] || '. ' || p[2] || '.' ELSE content END AS moderate,
         md5(content) AS complex_digest FROM s""", D)
def _(spark, root):
    c = F.col("content")
    return docs(spark, root).select(
        "doc_id",
        tx.lead_sentences(c, F.lit("simple")).alias("simple"),
        tx.lead_sentences(c, F.lit("moderate")).alias("moderate"),
        F.md5(tx.lead_sentences(c, F.lit("complex"))).alias("complex_digest"),
    )


# ---- chunking

SENT_CTE = rf"""sn AS (SELECT doc_id, category, title,
  string_split(regexp_replace(trim(content, {TRIM}), '([.!?]){WSQ}+', '\1' || chr(31), 'g'), chr(31)) AS s FROM v_docs)"""
GREEDY_CTE = SENT_CTE + """,
sl AS (SELECT doc_id, list_transform(s, lambda x: length(x)) AS l FROM sn),
g(doc_id, i, chunk, total) AS (
  SELECT doc_id, 1, 0, l[1] FROM sl
  UNION ALL SELECT g.doc_id, i + 1, CASE WHEN total > 350 THEN chunk + 1 ELSE chunk END, CASE WHEN total > 350 THEN 0 ELSE total END + l[i + 1]
  FROM g JOIN sl ON g.doc_id = sl.doc_id WHERE i < len(l)),
chunk0 AS (SELECT g.doc_id, chunk AS chunk_index, string_agg(s[i], ' ' ORDER BY i) AS content FROM g JOIN sn ON g.doc_id = sn.doc_id GROUP BY 1, 2),
chunks AS (SELECT c.doc_id || '_chunk_' || chunk_index AS chunk_id, c.doc_id, category, title, CAST(chunk_index AS BIGINT) AS chunk_index,
  count(*) OVER (PARTITION BY c.doc_id) AS total_chunks, content, length(content) AS char_count FROM chunk0 c JOIN sn ON c.doc_id = sn.doc_id)"""


def word_chunk_cte(name: str, overlap: int, size: int = 200) -> str:
    """Sentence chunks as word ranges, by recursion over the sentences."""
    back = f"greatest(r.b, r.pos - {overlap})" if overlap else "r.pos"
    return f"""
{name}_r(doc_id, i, b, pos, eb, ee) AS (
  SELECT doc_id, 0, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM wc
  UNION ALL SELECT r.doc_id, r.i + 1, CASE WHEN r.pos - r.b + n[r.i + 1] > {size} THEN {back} ELSE r.b END, r.pos + n[r.i + 1],
    CASE WHEN r.pos - r.b + n[r.i + 1] > {size} THEN r.b END, r.pos
  FROM {name}_r r JOIN wc ON r.doc_id = wc.doc_id WHERE r.i < len(n)),
{name}_b AS (SELECT doc_id, eb AS b, ee AS e FROM {name}_r WHERE eb < ee
  UNION ALL SELECT r.doc_id, b, pos FROM {name}_r r JOIN wc ON r.doc_id = wc.doc_id WHERE i = len(n) AND b < pos),
{name} AS (SELECT x.doc_id, row_number() OVER (PARTITION BY x.doc_id ORDER BY e) - 1 AS chunk_index, array_to_string(w[b + 1:e], ' ') AS content
  FROM {name}_b x JOIN tk ON x.doc_id = tk.doc_id)"""


WORD_CTE = SENT_CTE + rf""",
wc AS (SELECT doc_id, list_transform(s, lambda x: len({sql_tokens('x')})) AS n FROM sn),
tk AS (SELECT doc_id, {sql_tokens('content')} AS w FROM v_docs)"""


def greedy(spark, root):
    d = docs(spark, root)
    return ck.explode_chunks(d, ck.greedy_array(F.col("content")), ["category", "title"])


@query("sentence_chunks", f"WITH {WORD_CTE},{word_chunk_cte('ov', 50)} SELECT doc_id, chunk_index, content FROM ov", D, recursive=True)
def _(spark, root):
    d = docs(spark, root)
    return ck.explode_chunks(d, ck.sentence_word_array(F.col("content")), []).select("doc_id", "chunk_index", "content")


@query("greedy_chunks", f"WITH {GREEDY_CTE} SELECT doc_id, chunk_index, content FROM chunks", D, recursive=True)
def _(spark, root):
    return greedy(spark, root).select("doc_id", "chunk_index", "content")


@query("recursive_chunks")
def _(spark, root):
    return ck.explode_chunks(docs(spark, root), ck.recursive_array(F.col("content")), ["category", "title"])


PARAGRAPH_CTE = r"""pp AS (SELECT doc_id, string_split(content, chr(10)) AS ps FROM v_docs),
pc AS (SELECT doc_id, flatten(list_transform(ps, lambda p: CASE WHEN length(p) <= 500 THEN [{'t': p, 'g': chr(10), 'c': false}]
  ELSE list_transform(string_split(regexp_replace(p, '\. ', '.' || chr(31), 'g'), chr(31)), lambda s, i: {'t': s, 'g': ' ', 'c': i = 1}) END)) AS x FROM pp),
pr(doc_id, i, chunk, held) AS (
  SELECT doc_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT) FROM pc
  UNION ALL SELECT r.doc_id, i + 1, CASE WHEN x[i + 1].c OR held + length(x[i + 1].t) > 500 THEN chunk + 1 ELSE chunk END,
    CASE WHEN x[i + 1].c OR held + length(x[i + 1].t) > 500 THEN 0 ELSE held END + length(x[i + 1].t) + length(x[i + 1].g) FROM pr r JOIN pc ON r.doc_id = pc.doc_id WHERE i < len(x)),
pk AS (SELECT r.doc_id, chunk, regexp_replace(string_agg(x[i].t || x[i].g, '' ORDER BY i), '^\s+|\s+$', '', 'g') AS content FROM pr r JOIN pc ON r.doc_id = pc.doc_id WHERE i > 0 GROUP BY 1, 2),
pn AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk) - 1 AS chunk_index, content FROM pk WHERE content <> '')"""


@query("paragraph_chunks", f"""WITH {PARAGRAPH_CTE} SELECT pn.doc_id || '_chunk_' || chunk_index AS chunk_id, pn.doc_id, category, title, chunk_index,
  count(*) OVER (PARTITION BY pn.doc_id) AS total_chunks, pn.content, length(pn.content) AS char_count FROM pn JOIN v_docs d ON d.doc_id = pn.doc_id""", D, recursive=True)
def _(spark, root):
    # The corpus separates paragraphs by single newlines.
    return ck.explode_chunks(docs(spark, root), ck.paragraph_array(F.col("content"), separator="\n"), ["category", "title"])


@query("chunk_metadata", f"WITH {GREEDY_CTE} SELECT chunk_id, doc_id, category, title, chunk_index, total_chunks, char_count FROM chunks", D, recursive=True)
def _(spark, root):
    return greedy(spark, root).drop("content")


@query("chunk_size_distribution", f"""WITH {GREEDY_CTE} SELECT count(DISTINCT doc_id) AS documents, count(*) AS chunks,
  {r6("count(*) / count(DISTINCT doc_id)")} AS chunks_per_doc, min(char_count) AS min_chars, max(char_count) AS max_chars, {r6("avg(char_count)")} AS avg_chars
  FROM chunks""", D, recursive=True)
def _(spark, root):
    return rounded(ck.size_distribution(greedy(spark, root)))


# A frequent word of the English documents.
SWEEP_WORD = "there"


@query("chunk_size_sweep", f"""WITH {GREEDY_CTE},
m AS (SELECT len({sql_tokens("content")}) AS n, contains(lower(content), '{SWEEP_WORD}') AS hit FROM chunks)
SELECT CAST(sz AS INT) AS chunk_size, count(*) FILTER (n <= sz + 25) AS chunks,
  {r6("CASE WHEN count(*) FILTER (n <= sz + 25) > 0 THEN count(*) FILTER (n <= sz + 25 AND hit) / count(*) FILTER (n <= sz + 25) ELSE 0 END")} AS precision_score
FROM m, (SELECT unnest([50, 150, 300, 600]) AS sz) GROUP BY sz""", D, recursive=True)
def _(spark, root):
    return rounded(ck.size_sweep(greedy(spark, root), SWEEP_WORD))


@query("overlap_effect", f"""WITH {WORD_CTE},{word_chunk_cte('ov', 50)},{word_chunk_cte('nov', 0)},
u AS (SELECT 'with_overlap' AS variant, content FROM ov UNION ALL SELECT 'without_overlap', content FROM nov)
SELECT variant, count(*) AS chunks, {r6("avg(length(content))")} AS avg_chars, count(*) FILTER (contains(lower(content), '{SWEEP_WORD}')) AS keyword_hits
FROM u GROUP BY variant""", D, recursive=True)
def _(spark, root):
    return rounded(ck.overlap_effect(docs(spark, root), SWEEP_WORD))
