"""The chain against all labellings of short sequences, its gradient against differences, spans, and held-out accuracy."""

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import toxic_spans as ts
from corpusloom.llm.common import documents
from corpusloom.sources.tables import table

ROOT = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id bigint, text string, score double, spans string", "doc_id bigint, quality int, toxic int"


def every_labelling(e, states):
    """(marginals, expected state counts, log Z) of one sequence by summing over all labellings."""
    s, t01, t10, t11 = states
    total, p, counts = 0.0, np.zeros(len(e)), np.zeros(4)
    for y in product((0, 1), repeat=len(e)):
        pairs = list(zip(y, y[1:]))
        n = np.array([y[0], pairs.count((0, 1)), pairs.count((1, 0)), pairs.count((1, 1))])
        w = np.exp(np.dot(e, y) + n @ np.array([s, t01, t10, t11]))
        total, p, counts = total + w, p + w * np.array(y), counts + w * n
    return p / total, counts / total, np.log(total)


def test_marginals():
    rng = np.random.default_rng(5)
    sizes = [3, 1, 7, 2, 7, 5]
    e, states = rng.normal(size=sum(sizes)) * 2, rng.normal(size=4)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    p, counts = ts.chain(np.exp(e), first, states, pairs=True)
    want = [every_labelling(e[a : a + n], states) for a, n in zip(first, sizes)]
    assert np.allclose(p, np.concatenate([w[0] for w in want])) and np.allclose(counts, sum(w[1] for w in want))


def test_gradient(spark):
    """The gradient of the written log likelihood equals its differences."""
    rng = np.random.default_rng(6)
    seqs = [(rng.integers(0, 50, (n, ts.N_FEATURES)), rng.integers(0, 2, n)) for n in (4, 1, 6, 3, 5)]
    table_ = spark.createDataFrame([([int(x) for x in f.ravel()], [int(x) for x in y]) for f, y in seqs], "features array<int>, states array<tinyint>")
    weights, states = np.zeros(ts.BUCKETS), rng.normal(size=4)
    weights[:50] = rng.normal(size=50) * 0.3

    def likelihood(w, t):
        out = 0.0
        for f, y in seqs:
            e = w[f].sum(1)
            pairs = list(zip(y, y[1:]))
            n = np.array([y[0], pairs.count((0, 1)), pairs.count((1, 0)), pairs.count((1, 1))])
            out += e @ y + n @ t - every_labelling(e, t)[2]
        return out

    g = ts.gradients(table_, weights, states)
    for k in (0, 7, 31):
        up, down = weights.copy(), weights.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        assert abs((likelihood(up, states) - likelihood(down, states)) / 2e-5 - g[k]) < 1e-5
    for k in range(4):
        step = np.eye(4)[k] * 1e-5
        assert abs((likelihood(weights, states + step) - likelihood(weights, states - step)) / 2e-5 - g[ts.BUCKETS + k]) < 1e-5


def area(pairs):
    """Chance that a toxic document scores above another one, ties half."""
    scores = np.array([p[0] for p in pairs])
    toxic = np.array([p[1] for p in pairs]) == 1
    a, b = scores[toxic][:, None], scores[~toxic][None]
    return ((a > b) + 0.5 * (a == b)).mean()


def test_held_out(spark):
    labels = table(spark, ROOT, "labels")
    got = ts.toxic_digest(documents(spark, ROOT), labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "spans", "n_spans"]
    rows = got.join(labels, "doc_id").where("held_out").select("score", "toxic", "predicted").collect()
    print("area", area(rows), "toxic caught", np.mean([r.predicted for r in rows if r.toxic]), "others left", np.mean([1 - r.predicted for r in rows if not r.toxic]), len(rows))
    assert area(rows) > 0.9 and np.mean([1 - r.predicted for r in rows if not r.toxic]) > 0.98
    assert got.where("held_out <> (crc32(CAST(doc_id AS STRING)) % 5 = 0) OR score NOT BETWEEN 0 AND 1").isEmpty()


def made(n=400):
    """Invented documents: a third hold 'vile' or 'foul' in changing contexts."""
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(n):
        text = [words[k] for k in rng.integers(0, 60, 30)]
        toxic = int(i % 3 == 0)
        if toxic:
            for k in rng.integers(0, 30, 2):
                text[k] = ("vile", "foul")[int(k) % 2]
        rows.append((i, " ".join(text), 0.5, "x"))
        labels.append((i, 1, toxic))
    return rows, labels


def test_spans_and_edges(spark):
    rows, labels = made()
    long = "wörd " * 300_000 + "vile. end"
    odd = [(1000, None, 0.1, ""), (1001, "", 0.1, ""), (1002, "é vile w1", 0.1, ""), (None, "w2 foul w3", 0.1, ""), (1004, long, 0.1, ""), (1005, "w1 w2", 0.0, ""), (1005, "w1 w2", 0.0, "")]
    more = [(None, 1, 1), (1001, 1, None), (0, 0, 1), (5000, 1, 1)]
    docs = spark.createDataFrame(rows + odd, DOCS).repartition(3)
    known = spark.createDataFrame(labels + more, LABELS)
    got = {}
    for r in ts.toxic_digest(docs, known).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows) + 6 and sum(map(len, got.values())) == len(rows) + 7
    assert got[1002][0].spans == "2:6" and got[1002][0].predicted == 1 and got[None][0].spans == "3:7" and not got[None][0].held_out
    assert got[1004][0].spans == f"{5 * 300_000}:{5 * 300_000 + 4}"
    assert got[1000][0].score == got[1001][0].score < 0.5 and got[1005][0] == got[1005][1]
    assert all(got[i][0].predicted == t for i, _, t in labels)


def test_held_out_labels_are_not_read(spark):
    rows, labels = made(150)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    turned = known.withColumn("toxic", F.when(ts.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(ts.toxic_digest(docs, known, steps=3).collect()) == sorted(ts.toxic_digest(docs, turned, steps=3).collect())


def test_one_kind_and_empty(spark):
    docs = spark.createDataFrame(made(20)[0], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in ts.toxic_digest(docs, none).collect()} == {0.0}
    assert {r.predicted for r in ts.toxic_digest(docs, spark.createDataFrame([(i, 1, 1) for i in range(9)], LABELS)).collect()} == {1}
    assert ts.toxic_digest(spark.createDataFrame([], DOCS), none).isEmpty()
