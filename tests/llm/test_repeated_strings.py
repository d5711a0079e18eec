"""One sort finds the repeated hashes, wherever the borders of tasks and batches fall."""

import random
from collections import Counter

import pytest

from corpusloom.llm import suffix_dedup as sd


@pytest.mark.parametrize("tasks", [1, 3, 120])
@pytest.mark.parametrize("kinds", [3, 60])
def test_borders(spark, tasks, kinds):
    rnd = random.Random(kinds)
    rows = [(rnd.randrange(kinds) - kinds // 2, i, 7, None if rnd.random() < 0.2 else i * 10) for i in range(150)]
    n = Counter(w for w, *_ in rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        found = sd.repeated_strings(spark.createDataFrame(rows, "w long, id long, th long, s int"), tasks).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.id, r.low) for r in found} == {(i, s) for w, i, _, s in rows if s is not None and n[w] > 1}
    assert all(r.low == r.high for r in found)


def test_none(spark):
    assert sd.repeated_strings(spark.createDataFrame([], "w long, id long, th long, s int")).isEmpty()
