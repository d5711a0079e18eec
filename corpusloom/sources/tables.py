"""Table schemas and readers. Schemas are explicit, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(root, name))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan of fewer splits than cores over all cores, for work that is bound by CPU.

    A large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def table_stream(spark: SparkSession, root: str, name: str, bytes_per_trigger: int = 4 * 1024**3) -> DataFrame:
    """The same table as a file stream, with micro-batches of bounded size."""
    # the glob finds a single file as well as a folder of part files
    reader = spark.readStream.schema(SCHEMAS[name]).option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(f"{table_path(root, name)}*")


def whole_documents(spark: SparkSession, path: str) -> DataFrame:
    """Real document files (HTML or plain text): one row per file, decoded as UTF-8."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("path", "modificationTime", F.decode("content", "UTF-8").alias("raw"))
    )
