"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import materialise, scratch_path
from corpusloom.sources.tables import table

WHITE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents")


def lower_ascii(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def fresh(label: str) -> str:
    """A column name that no input column has."""
    return f"__{label}_{uuid.uuid4().hex[:8]}"


def sha256_hex(col):
    return F.sha2(col.cast("binary"), 256)


def write_once(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``materialise``, with the folder, so that a table that nothing reads any more can be discarded."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table. What was made from it must be written, not just planned."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def connected_components(edges: DataFrame, label: str = "components", most_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges`` (a, b), by alternating star steps.

    A large-star step links every larger neighbour of a node to the smallest neighbour, a small-star step every smaller one.
    Both are a map-side combined minimum and a join back, so a hub with a third of all edges is split like any skewed
    join. Each round is written to the shared folder, which cuts the lineage and survives lost executors. Self-links
    and nulls are ignored; nodes without a link are not in the result.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(now, label)
    for _ in range(most_rounds):
        # done when no node has two links upwards or is linked to as well as linked
        roots = now.select(F.col("b").alias("a")).distinct().withColumn("root", F.lit(True))
        if now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(roots, "a", "left").where("n > 1 OR root").isEmpty():
            break
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), label)
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large, label)
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), label)
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        now = materialise(small.where("a <> b").distinct(), label)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def batches_of(parts: Iterator, most_bytes: int, size) -> Iterator[list]:
    """Group items into lists of at most ``most_bytes`` together (one larger item makes a list of its own)."""
    held, total = [], 0
    for x in parts:
        n = size(x)
        if held and total + n > most_bytes:
            yield held
            held, total = [], 0
        held.append(x)
        total += n
    if held:
        yield held
