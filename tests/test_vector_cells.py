"""Stored cells: only probed folders are read, and within them the result is that of a full scan."""

import re

import numpy as np
import pytest

from corpusloom.operators import retrieval as rt
from corpusloom.operators import vector_cells as vc

DDL = "vec_id long, embedding array<float>"


def table(spark, n, size=16, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, size))
    rows = [(i, (middle[i % 12] + 0.5 * rng.normal(size=size)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(copies)] + [(10 * n + 99, None)]
    return spark.createDataFrame(rows, DDL).repartition(6), rows


def plain(rows, queries, centres, k, probes):
    unit = lambda v: np.array(v, float) / np.linalg.norm(v)
    near = lambda u, n: np.argsort(-np.round(centres @ u, 9), kind="stable")[:n]
    stored = [(i, unit(v)) for i, v in rows if v is not None]
    cell = {i: near(u, 1)[0] for i, u in stored}
    out = set()
    for q, v in queries:
        if v is None:
            continue
        probed = set(near(unit(v), probes))
        best = sorted((-round(float(u @ unit(v)), 6), i) for i, u in stored if cell[i] in probed and i != q)[:k]
        out |= {(q, i, -s, r) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("probes", [1, 3, 12])
def test_search(spark, tmp_path, probes):
    df, rows = table(spark, 900, copies=300)
    centres = vc.fixed_centres(df, 12)
    vc.write_cells(df, centres, str(tmp_path / "cells"))
    queries = [(i, rows[i][1]) for i in range(0, 900, 45)] + [(5000, None), (5001, [0.0] * 15 + [1.0])]
    q = spark.createDataFrame(queries, "query_id long, query_vec array<float>")
    got = vc.search_cells(spark, str(tmp_path / "cells"), centres, q, 7, probes, block=8)
    assert {tuple(r) for r in got.select("query_id", "hit_id", "score", "rank").collect()} == plain(rows, queries, centres, 7, probes)
    if probes == 12:
        exact = rt.vector_search(df, q, 7).select("query_id", "hit_id", "rank").collect()
        assert {tuple(r) for r in exact} == {(r.query_id, r.hit_id, r.rank) for r in got.collect()}


def test_only_probed_folders_are_read(spark, tmp_path):
    df, rows = table(spark, 600)
    centres = vc.fixed_centres(df, 12)
    vc.write_cells(df, centres, str(tmp_path / "cells"))
    one = spark.createDataFrame([(7, rows[7][1])], "query_id long, query_vec array<float>")
    plan = vc.search_cells(spark, str(tmp_path / "cells"), centres, one, 5, 2)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters and all("cell" in f for f in filters)
    # the vectors are read for the last rows only
    assert plan.count("embedding:array<float>") == 1 and "ReadSchema: struct<id:bigint,code:binary,gap:double>" in plan
    files = {re.search(r"cell=(\d+)", f)[1] for f in vc.cells(spark, str(tmp_path / "cells"), [1, 3]).inputFiles()}
    assert files <= {"1", "3"}


def test_no_queries_and_no_vectors(spark, tmp_path):
    df, _ = table(spark, 30)
    centres = vc.fixed_centres(df, 4)
    vc.write_cells(df, centres, str(tmp_path / "cells"))
    none = spark.createDataFrame([], "query_id long, query_vec array<float>")
    assert vc.search_cells(spark, str(tmp_path / "cells"), centres, none, 5, 2).isEmpty()
