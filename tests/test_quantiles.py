import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.monitoring import anomalies
from corpusloom.operators.quantiles import as_row, exact_percentiles

WANTED = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("scale", [1.0, 1e-300, -1e300])
def test_exact(spark, scale):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 5000, p=[0.9, 0.09, 0.01]), "v": np.round(rng.lognormal(3, 1, 5000), 2) * scale})
    pdf.loc[:1700, "v"] = 20.0 * scale  # a third of all rows share one value
    df = spark.createDataFrame(pdf).repartition(6)
    got = exact_percentiles(df, "v", WANTED, by=["g"]).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        for name, p in WANTED.items():
            assert got.loc[g, name] == pytest.approx(part.v.quantile(p), rel=1e-9)
    whole = exact_percentiles(df, "v", WANTED).first()
    for name, p in WANTED.items():
        assert whole[name] == pytest.approx(pdf.v.quantile(p), rel=1e-9)


def test_all_kinds_of_values(spark):
    """Zeros, signs, infinities, nulls, null groups and one value: the buckets keep the order of the values."""
    values = [0.0, -0.0, 5e-324, -5e-324, 1.5, -1.5, float("inf"), float("-inf"), 3.0, 2.9999999999999996, None, 1e308, -1e308, 3.0]
    rows = [(g, v) for g in (None, "a") for v in values] + [("one", 7.25), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    ordered = sorted(v for v in values if v is not None)
    wanted = {f"p{k}": k / (len(ordered) - 1) for k in range(len(ordered))}
    got = {r.g: r for r in exact_percentiles(df, "v", wanted, by=["g"], extra=[F.count(F.lit(1)).alias("rows")]).collect()}
    assert set(got) == {None, "a", "one"} and got["one"].p3 == 7.25 and got["a"].rows == len(values)
    for g in (None, "a"):
        for k, v in enumerate(ordered):
            assert got[g][f"p{k}"] == v or v in (float("inf"), float("-inf"))
    assert exact_percentiles(df.where("v IS NULL"), "v", {"p": 0.5}, extra=[F.count(F.lit(1)).alias("rows")]).first() == (None, 3)


def test_values_of_one_bucket(spark):
    """Values that differ in their last places only share a bucket and are ranked one by one."""
    df = spark.range(3000).select((F.lit(1000.0) + F.col("id") * 1e-6).alias("v"))
    r = exact_percentiles(df, "v", {"a": 0.5, "b": 0.999}).first()
    assert r.a == pytest.approx(1000 + 1499.5e-6, abs=1e-12) and r.b == pytest.approx(1000 + 0.999 * 2999e-6, abs=1e-12)


def test_nearest_rank(spark):
    twenty = spark.range(1, 21).selectExpr("cast(id as double) v")
    ten = spark.range(1, 11).selectExpr("cast(id as double) v")
    assert exact_percentiles(twenty, "v", {"p": 0.95}, method="nearest").first().p == 20
    assert exact_percentiles(ten, "v", {"p": 0.95}, method="nearest").first().p == 10


def test_as_row_refuses_a_second_row(spark):
    with pytest.raises(ValueError):
        as_row(spark.range(2))
    assert spark.range(1).select(as_row(spark.range(7, 8))["id"]).first()[0] == 7


def test_anomalies_of_a_constant_measure(spark):
    log = spark.createDataFrame([(k, 5.0, 10) for k in range(4)], "request_id bigint, latency_ms double, total_tokens bigint")
    base = spark.createDataFrame([(5.0, 0.0, 0.0, 9.0, 10.0, 0.0)], "latency_mean double, latency_std double, latency_p99 double, latency_iqr_high double, tokens_mean double, tokens_std double")
    assert {r.kind for r in anomalies(log, base).collect()} == {"latency_percentile"}
