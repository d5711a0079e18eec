"""Crowds of sets that share a common stock: the prefix join forms few pairs, and no similar pair is lost."""

import numpy as np
import pytest

from corpusloom.llm import tensored_minhash as tm


def members(rows):
    return [(i, bytearray(np.unique(np.array(s, np.uint64)).tobytes())) for i, s in rows]


@pytest.mark.parametrize("n", [500, 2000])
def test_few_pairs_of_a_stock(spark, n):
    rng = np.random.default_rng(n)
    stock = rng.integers(0, 2**63, 100, dtype=np.uint64)
    rows = [(i, rng.choice(stock, 60, replace=False)) for i in range(n)]
    rows += [(n + i, np.append(rows[i][1][:-3], rng.integers(0, 2**63, 3, dtype=np.uint64))) for i in range(40)]  # similar to one each
    sets = spark.createDataFrame(members(rows), "id long, members binary").repartition(4)
    of = sets.selectExpr("id", "id AS component")
    pairs = {tuple(r) for r in tm.prefix_pairs(sets, of, 80).collect()}
    assert len(pairs) < 20_000
    assert {(i, n + i) for i in range(40)} <= pairs


def test_no_similar_pair_is_lost(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(60):
        base = rng.integers(0, 2**63, int(rng.integers(1, 400)), dtype=np.uint64)
        for _ in range(4):
            keep = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.1, 0.2])]
            rows.append((len(rows), np.append(keep, rng.integers(0, 2**63, int(rng.integers(0, 1 + len(base) // 8)), dtype=np.uint64))))
    rows = [(i, s) for i, s in rows if len(s)]
    sets = spark.createDataFrame(members(rows), "id long, members binary").repartition(4)
    pairs = {tuple(r) for r in tm.prefix_pairs(sets, sets.selectExpr("id", "id AS component"), 80).collect()}
    held = {i: set(s.tolist()) for i, s in rows}
    want = {(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b])}
    assert want <= pairs and len(want) > 50
