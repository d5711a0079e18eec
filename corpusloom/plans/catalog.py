"""All registered queries."""

from __future__ import annotations

from corpusloom.plans import corpus_queries, evaluation_queries, guardrail_queries, monitoring_queries, retrieval_queries, stateful_queries  # noqa: F401
from corpusloom.plans.registry import ORACLES, QUERIES

FLAGSHIP = "answer_batch"


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
