"""From raw documents to a mix: five stages, each written as Parquet and read again by the next.

The quality classifier rejects documents, near-duplicates go but for one of each group, benchmark passages are cut out,
secrets are masked, and the sources are mixed to their target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.common import documents, materialise
from corpusloom.llm.decontamination import remove_leaks
from corpusloom.llm.importance import resample
from corpusloom.llm.mixing import mix_sources
from corpusloom.llm.secret_scan import redact_secrets
from corpusloom.llm.tensored_minhash import drop_near_duplicates
from corpusloom.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards the labelled good ones."""
    return resample(docs, table(spark, sf_dir, "labels"))[1]


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group that shares 0.8 of its five-word shingles."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark passages."""
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken from each."""
    return mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scan", secrets),
    ("source mixing", mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
