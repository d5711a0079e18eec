"""Shallot clustering against a full scan, and its edge cases."""

import hashlib

import numpy as np
import pytest

from corpusloom.llm import shallot

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, v string"


def plain(rows, k=16, rounds=3, size=64):
    kept = [(i, np.floor(64 * np.array(e, np.float32).astype(float)).astype(int)) for i, e, *_ in rows if e is not None and len(e) == size and all(x is not None and np.isfinite(x) for x in e)]
    key = lambda p: (hashlib.sha256(f"1:{'null' if p[0] is None else p[0]}".encode()).hexdigest(), list(p[1]))
    c = [list(map(int, v)) for _, v in sorted(kept, key=key)[:k]]
    nearest = lambda v: min((sum((int(x) - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            if own := [v for (_, v), a in zip(kept, at) if a == j]:
                c[j] = [int(sum(int(v[i]) for v in own)) // len(own) for i in range(size)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = {j: sum(d for _, a, d in last if a == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return [(i, j, d, sums[j], sum(sums.values()), sha[j]) for i, j, d in last]


def check(spark, rows, **params):
    got = [tuple(r) for r in shallot.cluster_digest(spark.createDataFrame(rows, SCHEMA).repartition(3), **params).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=order) == sorted(plain(rows, **params), key=order)


def cloud(n, size=64, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(20, size))
    return [(i, (middle[i % 20] + rng.normal(size=size) * 0.4).astype(np.float32).tolist(), 1, 2, "x") for i in range(n)]


def test_full_scan(spark):
    check(spark, cloud(900))


def test_ties_and_copies(spark):
    """Few distinct points of few distinct components: many equal distances, repeated ids, equal centroids."""
    rng = np.random.default_rng(2)
    rows = [(i // 2, (rng.integers(0, 2, 4) / 64).tolist(), 0, 0, "") for i in range(300)]
    check(spark, rows, size=4)
    check(spark, [(i, [0.5] * 4, 0, 0, "") for i in range(40)], size=4)


def test_what_is_left_out(spark):
    bad = [None, [], [0.1] * 63, [0.1] * 65, [0.1] * 63 + [None], [0.1] * 63 + [float("nan")], [0.1] * 63 + [float("-inf")]]
    rows = [*cloud(30), *[(100 + i, e, 0, 0, "") for i, e in enumerate(bad)], (None, [-0.3] * 64, 0, 0, "")]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, rows[:9])
    assert shallot.cluster_digest(spark.createDataFrame(rows[30:37], SCHEMA)).isEmpty()
    assert shallot.cluster_digest(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_too_large(spark):
    with pytest.raises(Exception, match="beyond"):
        shallot.cluster_digest(spark.createDataFrame([(1, [1e9] * 64, 0, 0, "")], SCHEMA)).collect()


def test_bounds_save_work():
    """Later rounds compare far fewer centroids than a full scan."""
    x = np.floor(64 * np.array([r[1] for r in cloud(4000, seed=3)])).astype(np.int64)
    c = x[:16].copy()
    a, b, upper, lower = np.zeros(len(x), np.int64), np.ones(len(x), np.int64), np.full(len(x), np.inf), np.zeros(len(x))
    before, counts = None, []
    for _ in range(6):
        a, b, upper, lower, _, n = shallot.Ball(c, before).assign(x, a, b, upper, lower, False)
        full = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (a == full.argmin(1)).all()
        counts.append(n)
        before, c = c, np.array([x[a == j].sum(0) // max(1, (a == j).sum()) if (a == j).any() else c[j] for j in range(16)])
    assert counts[-1] < 4000 * 16 / 4
