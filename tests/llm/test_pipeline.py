"""The pipeline: every stage keeps the columns of its input, and its decisions take effect."""

import corpus_pipeline
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, secret_scan, tensored_minhash
from corpusloom.llm.common import documents
from corpusloom.sources.tables import table

ROOT = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, ROOT)
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, ROOT), "test-stage")
        assert docs.columns == columns and 0 < docs.count() <= before, name
        assert docs.where("n_chars <> length(text)").isEmpty()
        before = docs.count()
    leaks = decontamination.leak_digest(docs, table(spark, ROOT, "benchmark"))
    assert tensored_minhash.near_duplicates(docs).where("NOT kept").count() <= leaks.where("contaminated").count() + before // 20
    assert secret_scan.secret_digest(docs).where("n_assign + n_access + n_hex > 0").isEmpty()
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT)
    sums = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert sums and all(abs(r.taken - r.target) <= 1 for r in sums)
