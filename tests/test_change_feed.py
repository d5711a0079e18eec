"""The change feed in batch and stream against the comparison of the tables."""

from corpusloom.sources import change_feed as cf
from corpusloom.sources import sinks
from corpusloom.streaming.stateful import run_available

DDL = "id long, c string"
VERSIONS = [
    [(i, f"text {i}") for i in range(60)] + [(70, None)],
    [(i, f"text {i}" if i % 3 else f"new {i}") for i in range(10, 80)],
    [],
    [(5, None), (6, ""), (None, "no key")],
]


def actions(rows):
    return sorted((r.version, r.key, r.action) for r in rows)


def test_feed(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    frames = [spark.createDataFrame(rows, DDL) for rows in VERSIONS]
    want = []
    for version, df in enumerate(frames, 1):
        cf.write_digests(df, path, version, "id", "c", buckets=5)
        before = frames[version - 2] if version > 1 else spark.createDataFrame([], DDL)
        whole = lambda x: x.where("id IS NOT NULL").selectExpr("id", "coalesce(c, '<null>') AS c")
        want += [(version, r.id, r.action) for r in sinks.index_changes(whole(df), whole(before), "id", "c").collect()]
    assert actions(cf.change_feed(spark, path, buckets=5).collect()) == sorted(want)
    assert actions(cf.change_feed(spark, path, buckets=5, start=1, end=2).collect()) == sorted(w for w in want if w[0] == 2)
    assert actions(run_available(cf.change_feed(spark, path, stream=True, buckets=5), "feed").collect()) == sorted(want)


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    """A second run with the same checkpoint reads the new versions only."""
    path, out, ck = (str(tmp_path / x) for x in ("snapshots", "out", "ck"))

    def run():
        stream = cf.change_feed(spark, path, stream=True, buckets=3).writeStream.format("parquet")
        stream.option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
        return actions(spark.read.schema(cf.SCHEMA).parquet(out).collect())

    cf.write_digests(spark.createDataFrame([(1, "a"), (2, "b")], DDL), path, 1, "id", "c", buckets=3)
    assert run() == [(1, 1, "insert"), (1, 2, "insert")]
    cf.write_digests(spark.createDataFrame([(2, "B"), (3, "c")], DDL), path, 2, "id", "c", buckets=3)
    assert run() == [(1, 1, "insert"), (1, 2, "insert"), (2, 1, "delete"), (2, 2, "update"), (2, 3, "insert")]


def test_no_snapshots(spark, tmp_path):
    assert cf.change_feed(spark, str(tmp_path / "none")).isEmpty()
