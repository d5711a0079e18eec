"""Exact order statistics that never put a whole group into one task.

``percentile`` keeps every distinct value of a group in one reducer. Here values fall into buckets of a fixed relative width,
in order of size, and each task sends one counter per group and bucket: a histogram that is merged like any sum and
that no value can miss. Running sums over it tell in which bucket a rank lies. Only values of those buckets, a small share of
a group, are counted one by one and ranked, bucket by bucket. The result is exact, the plan is one plan without any job
while it is built, and nothing depends on the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 1024  # buckets for each doubling of a value
OFFSET = 1_200_000  # above STEPS x the largest exponent, so that a bucket has its value's sign
EDGE = 1 << 29


def as_row(df: DataFrame) -> Column:
    """A one-row frame as a struct column.

    The row is computed once, here, and enters later plans as a scalar subquery over a local row. Plans
    that use it in many places neither repeat its jobs nor grow by its plan. A second row is an error.
    """
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("as_row needs a frame of one row")
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return local.select(F.struct("*").alias("row")).scalar()


def value_bucket(v: Column) -> Column:
    """A bucket number that never falls as the value grows. NaN is the largest value, as everywhere in Spark."""
    size = F.floor(F.log2(F.abs(v)) * STEPS) + OFFSET
    finite = F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0))
    edge = F.when(F.isnan(v), F.lit(2 * EDGE)).when(v == float("inf"), F.lit(EDGE)).when(v == float("-inf"), F.lit(-EDGE))
    return F.coalesce(edge.cast("bigint"), F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0)).otherwise(finite)).cast("bigint")


def exact_percentiles(
    df: DataFrame, value: str | Column, wanted: Mapping[str, float], by: Sequence[str] = (), extra: Sequence[Column] = (), method: str = "linear"
) -> DataFrame:
    """One row per group: the keys, ``extra`` aggregates and one column per wanted percentile.

    ``linear`` interpolates between neighbours, as pandas and ``percentile`` do. ``nearest`` takes the
    zero-based rank ``int(n * p)`` when a group has at least 20 rows, else its maximum. ``extra`` is
    computed over all columns of ``df``. A group without values has no row, a frame without values one row of nulls.
    """
    by, names = list(by), list(wanted)
    v = F.col("_v")
    value = F.col(value) if isinstance(value, str) else value
    narrow = df.select(*by, value.cast("double").alias("_v")).where(v.isNotNull()).withColumn("_b", value_bucket(v))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    order = group.orderBy("_b")  # a row for each bucket, however many values
    ends = narrow.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c")).select(
        *by, "_b", (F.sum("_c").over(order) - F.col("_c")).alias("_start"), F.sum("_c").over(order).alias("_end"), F.sum("_c").over(group).alias("_n")
    )
    n, ranks = F.col("_n"), []
    for i, p in enumerate(wanted.values()):
        if method == "linear":
            pos = F.lit(float(p)) * (n - 1)
        elif method == "nearest":
            pos = F.when(n >= 20, F.floor(n * F.lit(float(p)))).otherwise(n - 1).cast("double")
        else:
            raise ValueError(f"unknown method {method}")
        ranks += [F.floor(pos).alias(f"r{i}"), F.ceil(pos).alias(f"s{i}"), (pos - F.floor(pos)).alias(f"f{i}")]
    ends = ends.withColumn("_r", F.struct(*ranks))
    sides = [f"{x}{i}" for i in range(len(names)) for x in "rs"]
    within = lambda rank: (F.col("_start") <= F.col(f"_r.{rank}")) & (F.col(f"_r.{rank}") < F.col("_end"))
    asked = ends.where(reduce(or_, map(within, sides))).select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_b").alias("_k_b"), "_start", "_r")
    if not by:
        asked = F.broadcast(asked)  # two rows a percentile at most
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by] + [F.col("_b") == F.col("_k_b")]
    counted = narrow.join(asked, on).groupBy(*by, "_b", "_v", "_start", "_r").agg(F.count(F.lit(1)).alias("_c"))
    run = F.sum("_c").over(Window.partitionBy(*by, "_b").orderBy("_v"))
    ranked = counted.withColumn("_end", F.col("_start") + run).withColumn("_start", F.col("_end") - F.col("_c"))
    at = lambda rank: F.max(F.when(within(rank), v)).alias(f"_{rank}")
    picked = ranked.groupBy(*by).agg(*map(at, sides), *[F.first(f"_r.f{i}").alias(f"_f{i}") for i in range(len(names))])
    exact = [(F.col(f"_r{i}") + (F.col(f"_s{i}") - F.col(f"_r{i}")) * F.col(f"_f{i}")).alias(name) for i, name in enumerate(names)]
    result = picked.select(*by, *exact)
    if not extra:
        return result
    stats = df.groupBy(*by).agg(*extra)
    if not by:
        return result.withColumn("_e", stats.select(F.struct("*")).scalar()).select(*names, "_e.*")
    added = [c for c in stats.columns if c not in by]
    stats = stats.select(*[F.col(c).alias(f"_k_{c}") for c in by], *added)
    return result.join(stats, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]).select(*by, *names, *added)
