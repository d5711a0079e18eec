"""Top-k against brute force, over the broadcast path and the blocked path."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import retrieval as rt

LIMITS = [{}, {"max_broadcast_queries": 3, "corpus_block_rows": 20}]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    mat = rng.normal(size=(120, 8)).astype(np.float32)
    mat[50] = mat[7]  # a copy, to force a tie
    rows = [(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(mat)]
    return mat.astype(np.float64), spark.createDataFrame(rows, "id bigint, v array<float>, cat int").repartition(5)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("filtered", [False, True])
def test_vector_search(spark, vectors, limits, filtered):
    mat, df = vectors
    queries = df.where(F.col("id") < 10)
    hits = rt.vector_search(df, queries, 4, filtered=filtered, **limits).collect()
    got = {(r.query_id, r.rank): (r.hit_id, r.score) for r in hits}
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    for q in range(10):
        scores = np.round(unit @ unit[q], 6)
        cand = [i for i in range(120) if i != q and (not filtered or i % 3 == q % 3)]
        best = sorted(cand, key=lambda i: (-scores[i], i))[:4]
        assert [got[(q, r + 1)][0] for r in range(4)] == best


WORDS = "alpha beta gamma delta alphabet bet gam lt da".split()


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(WORDS).title(), "c", " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 6)))) for i in range(80)]
    # A third of all documents are copies of one text.
    rows += [(100 + i, "Alpha", "c", "alpha beta") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, title string, category string, content string").repartition(4)
    q = [(i, " ".join(rnd.choice(WORDS + ["what", "is", "zz"]) for _ in range(3))) for i in range(9)]
    return rows, df, q, spark.createDataFrame(q, "query_id bigint, question string")


def brute(rows, q, k, score, positive):
    out = {}
    for qid, text in q:
        scored = [(score(text, r), r[0]) for r in rows]
        scored = [(s, i) for s, i in scored if s > 0 or not positive]
        out[qid] = [(i, s) for s, i in sorted(scored, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.hit_id, r.score))
    return out


@pytest.mark.parametrize("limits", LIMITS)
def test_keyword_searches(texts, limits):
    rows, df, q, queries = texts
    stop = set(rt.RELEVANCE_STOP)

    def relevance(text, r):
        terms = set(text.split()) - stop
        return float(sum(t in r[3] for t in terms) + 2 * sum(t in r[1].lower() for t in terms))

    def bag(text, r):
        return float(sum(t in r[3] for t in text.split()))

    def fraction(text, r):
        long = [t for t in text.split() if len(t) > 3]
        return round(sum(t in r[3] for t in long) / max(len(long), 1), 6)

    def like(text, r):
        long = [t for t in text.split() if len(t) > 3][:5] or text.split()[:3]
        return 0.5 if any(t in r[3] for t in long) else 0.0

    assert collected(rt.relevance_search(df, queries, 3, **limits)) == brute(rows, q, 3, relevance, False)
    drop_empty = lambda d: {k: v for k, v in d.items() if v}
    assert collected(rt.bag_search(df, queries, 3, **limits)) == drop_empty(brute(rows, q, 3, bag, True))
    assert collected(rt.fraction_search(df, queries, 5, **limits)) == drop_empty(brute(rows, q, 5, fraction, True))
    assert collected(rt.any_term_search(df, queries, 5, **limits)) == drop_empty(brute(rows, q, 5, like, True))


def test_context_budget(spark):
    hits = spark.createDataFrame(
        [(1, 1, "A", "x" * 100), (1, 2, "B", "y" * 300), (1, 3, "C", "z"), (2, 1, "A", "w" * 500)], "query_id long, rank long, title string, content string"
    )
    got = {r.query_id: r for r in rt.assemble_context(hits, 300).collect()}
    first = "[Document 1: A]\n" + "x" * 100
    assert got[1].context == first + "\n\n" + ("[Document 2: B]\n" + "y" * 300)[: 300 - len(first)] + "..."
    assert got[1].passages == 2
    assert got[2].context == ("[Document 1: A]\n" + "w" * 500)[:300] + "..."
    # With 100 characters or fewer left nothing is added.
    tight = rt.assemble_context(hits.where("query_id = 1"), len(first) + 100).first()
    assert tight.context == first and tight.passages == 1


def test_measures(spark):
    judged = spark.createDataFrame([(1, 1, True), (1, 2, False), (2, 1, False), (2, 2, True), (3, 1, False)], "query_id long, rank long, relevant boolean")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id long")
    m = rt.retrieval_measures(rt.per_query_relevance(judged, queries)).first()
    assert (m.queries, round(m.hit_rate, 6), m.mrr) == (3, 0.666667, 0.5)


def test_approximate_recall(spark, vectors):
    _, df = vectors
    q = df.select("id", "v")
    celled, centres = rt.assign_cells(df, cells=6)
    full = rt.recall_at_k(rt.approximate_search(celled, centres, q, 5, probes=6), rt.vector_search(df, q, 5)).first()
    part = rt.recall_at_k(rt.approximate_search(celled, centres, q, 5, probes=3), rt.vector_search(df, q, 5)).first()
    assert full.recall == 1.0 and 0.5 < part.recall <= 1.0
