"""Batch sinks and table comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and return a reader of the same schema. Overwrite can be repeated safely."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_snapshot(df: DataFrame, path: str, version: str, category: str) -> DataFrame:
    """Write one version of a table to its own partition and return the version's manifest."""
    target = f"{path}/version={version}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target).groupBy().agg(
        F.lit(version).alias("version"),
        F.count(F.lit(1)).alias("row_count"),
        F.array_join(F.sort_array(F.collect_set(category)), ",").alias("categories"),
    )


def index_changes(current: DataFrame, indexed: DataFrame, key: str, content: str) -> DataFrame:
    """Rows (key, action) that bring an index up to date: insert, update or delete.

    Only keys and content hashes are shuffled. Text is joined later, for the changed rows alone.
    """
    new = current.select(key, F.xxhash64(content).alias("new_hash"))
    old = indexed.select(key, F.xxhash64(content).alias("old_hash"))
    action = (
        F.when(F.col("old_hash").isNull(), "insert")
        .when(F.col("new_hash").isNull(), "delete")
        .when(F.col("old_hash") != F.col("new_hash"), "update")
    )
    return new.join(old, key, "full_outer").select(key, action.alias("action")).where(F.col("action").isNotNull())


def apply_changes(indexed: DataFrame, current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The index after the changes: untouched rows plus the current form of inserted and updated ones."""
    keep = indexed.join(changes.select(key), key, "left_anti")
    fresh = current.join(changes.where(F.col("action") != "delete").select(key), key, "left_semi")
    return keep.unionByName(fresh)


def tagged_union(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Union of differently shaped sources with a type tag; absent columns become NULL."""
    out = None
    for tag, df in parts:
        df = df.withColumn("doc_type", F.lit(tag))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def ingest_stamp(docs: DataFrame) -> DataFrame:
    return docs.withColumn("created_at", F.current_timestamp()).withColumn("embedding_status", F.lit("pending")).withColumn(
        "indexed_at", F.lit(None).cast("timestamp")
    )
