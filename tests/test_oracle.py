"""Every registered query against its SQL form, on the smallest test data."""

import re

import pytest
from compare import compare, oracle_connection

from corpusloom.plans import catalog

ROOT = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"latency_outliers", "pii_spans", "pii_spans_profile_b", "pii_offsets", "pii_distribution", "conflicting_hits", "alert_rules", "windowed_alerts"}


@pytest.fixture(scope="session")
def con():
    return oracle_connection(ROOT)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    state, text, _ = compare(spark, con, ROOT, name, catalog.queries()[name], catalog.oracle_sql().get(name))
    assert state in ("ok", "rows") or (state == "EMPTY" and name in MAY_BE_EMPTY), text
    assert "TYPES" not in text, text


def test_names():
    assert not any("pipeline" in n or re.match(r"op\d*_", n) for n in catalog.queries())
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
