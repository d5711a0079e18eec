"""The engine's logical inputs, bound to the stored tables.

Each function has a twin in ``ORACLE_VIEWS``: the same definition as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.sources.tables import spread, table

PROPS_SCHEMA = "k int"


def traffic_columns(events: DataFrame) -> DataFrame:
    k = F.from_json("props", PROPS_SCHEMA)["k"].cast("bigint")
    out = F.floor("value").cast("bigint")
    levels = F.array(F.lit("simple"), F.lit("moderate"), F.lit("complex"))
    return events.select(
        F.col("event_id").alias("request_id"),
        "ts",
        "user_id",
        F.col("event_type").alias("category"),
        F.col("value").alias("latency_ms"),
        k.alias("input_tokens"),
        out.alias("output_tokens"),
        (k + out).alias("total_tokens"),
        (k / F.lit(100.0)).alias("quality_score"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.element_at(levels, (F.col("user_id") % 3 + 1).cast("int")).alias("complexity"),
    )


def traffic(spark: SparkSession, root: str) -> DataFrame:
    return traffic_columns(table(spark, root, "events"))


def docs(spark: SparkSession, root: str) -> DataFrame:
    return spread(table(spark, root, "documents"), "doc_id").select(
        "doc_id",
        F.col("lang").alias("category"),
        "source",
        tx.first_line(F.col("text")).alias("title"),
        F.col("text").alias("content"),
    )


def prompts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")


def questions(spark: SparkSession, root: str) -> DataFrame:
    """Evaluation questions as text."""
    return table(spark, root, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def question_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Evaluation questions with their vector and category."""
    vec = table(spark, root, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"), F.col("label").alias("category")
    )
    return questions(spark, root).join(vec, "query_id")


def qa(spark: SparkSession, root: str) -> DataFrame:
    """Each user turn with the assistant turn right after it, its context and its reference answer.

    The pair is found by an equi-join on (conversation, turn), so one long conversation is spread
    over all tasks.
    """
    conv = table(spark, root, "conversations")
    ask = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    reply = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    ctx = table(spark, root, "documents").select(F.col("doc_id").alias("conv_id"), F.col("text").alias("context"))
    bench = table(spark, root, "benchmark")
    n_items = bench.agg(F.count(F.lit(1))).scalar()
    truth = bench.select(F.col("item_id").alias("truth_id"), F.col("text").alias("ground_truth"))
    return (
        ask.join(reply, ["conv_id", "turn"])
        .join(ctx, "conv_id")
        .withColumn("truth_id", F.col("conv_id") % n_items)
        .join(truth, "truth_id")
        .drop("truth_id")
    )


def claims(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("claim_id"),
        F.col("o_totalprice").alias("estimated_cost"),
        F.col("o_custkey").alias("policy_id"),
        F.col("o_orderpriority").alias("description"),
    )


def policies(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select(
        F.col("c_custkey").alias("policy_id"), (F.col("c_acctbal") > 0).alias("active")
    )


ORACLE_VIEWS = {
    "v_traffic": r"""v_traffic AS (
  SELECT event_id AS request_id, ts, user_id, event_type AS category, value AS latency_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS input_tokens,
         CAST(floor(value) AS BIGINT) AS output_tokens,
         CAST(json_extract_string(props, '$.k') AS BIGINT) + CAST(floor(value) AS BIGINT) AS total_tokens,
         CAST(json_extract_string(props, '$.k') AS BIGINT) / CAST(100 AS DOUBLE) AS quality_score,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         (['simple', 'moderate', 'complex'])[user_id % 3 + 1] AS complexity
  FROM events)""",
    "v_docs": r"""v_docs AS (
  SELECT doc_id, lang AS category, source, split_part(text, chr(10), 1) AS title, text AS content FROM documents)""",
    "v_prompts": r"""v_prompts AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')""",
    "v_questions": r"""v_questions AS (SELECT item_id AS query_id, text AS question FROM benchmark)""",
    "v_question_vectors": r"""v_question_vectors AS (
  SELECT item_id AS query_id, text AS question, CAST(embedding AS DOUBLE[]) AS query_vec, label AS category
  FROM benchmark JOIN embeddings ON item_id = vec_id)""",
    "v_qa": r"""v_qa AS (
  SELECT c.conv_id, c.turn, c.text AS question, c.next_text AS answer, d.text AS context, b.text AS ground_truth
  FROM (SELECT conv_id, turn, role, text,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role
        FROM conversations) c
  JOIN documents d ON d.doc_id = c.conv_id
  JOIN benchmark b ON b.item_id = c.conv_id % (SELECT count(*) FROM benchmark)
  WHERE c.role = 'user' AND c.next_role = 'assistant')""",
    "v_claims": r"""v_claims AS (
  SELECT o_orderkey AS claim_id, o_totalprice AS estimated_cost, o_custkey AS policy_id, o_orderpriority AS description,
         c_custkey IS NOT NULL AND coalesce(c_acctbal > 0, false) AS active
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)""",
}
