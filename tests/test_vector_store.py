"""Each text is embedded once; copies, repeated ids, null and short texts; a repeated run changes nothing."""

from pyspark.sql import functions as F

from corpusloom.operators import vector_store as vs

DDL = "doc_id long, content string"


def test_store(spark, tmp_path):
    path, seen = str(tmp_path / "store"), []

    def embed(df, c):
        seen.append(sorted(r[c] for r in df.collect()))
        return df.withColumn("embedding", F.array(F.length(c).cast("float")))

    first = spark.createDataFrame([(1, "alpha"), (2, "alpha"), (3, "beta!"), (3, "gamma!!")], DDL)
    second = spark.createDataFrame([(1, "alpha"), (5, "beta!"), (6, None), (7, "delta....."), (8, "delta....."), (9, "")], DDL)
    vs.embed_new(first, path, 0, embed)
    vs.embed_new(second, path, 1, embed)
    vs.embed_new(second, path, 1, embed)
    assert seen == [["alpha", "beta!", "gamma!!"], ["", "delta....."], ["", "delta....."]]
    got = {(r.doc_id, r.content): (r.embedding, r.run) for r in vs.with_vectors(first.union(second), path).collect()}
    assert got == {
        (1, "alpha"): ([5.0], 0), (2, "alpha"): ([5.0], 0), (3, "beta!"): ([5.0], 0), (3, "gamma!!"): ([7.0], 0), (5, "beta!"): ([5.0], 0), (6, None): (None, None),
        (7, "delta....."): ([10.0], 1), (8, "delta....."): ([10.0], 1), (9, ""): ([0.0], 1),
    }
    assert vs.stored_vectors(spark, path).count() == 5


def test_default_model(spark, tmp_path):
    df = spark.createDataFrame([(1, "a text that is long enough"), (2, "short")], DDL)
    vs.embed_new(df, str(tmp_path / "s"), 0)
    got = {r.doc_id: r.embedding for r in vs.with_vectors(df, str(tmp_path / "s")).collect()}
    assert got[2] is None and abs(sum(x * x for x in got[1]) - 1) < 1e-5
