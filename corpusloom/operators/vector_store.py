"""Vectors addressed by content: a text is embedded once, however often and wherever it stands.

The store keeps (digest of the text, vector, run) by parts, one a run. A run takes one document of each digest that the store lacks,
so copies are merged on the map side and texts that were embedded before are not read again; vectors come back to all
documents by their digest. What is shuffled are ids and digests, the texts of new representatives, and vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.embedding import hashed_embeddings
from corpusloom.streaming.parts import part_path, read_parts

STORE_DDL = "digest string, embedding array<float>, run bigint"


def content_digest(text_col: str):
    """SHA-256 of the text; null for null."""
    return F.sha2(F.col(text_col), 256)


def stored_vectors(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    return read_parts(spark, path, STORE_DDL, before)


def embed_new(docs: DataFrame, path: str, run: int, embed: Callable[[DataFrame, str], DataFrame] | None = None, text_col: str = "content") -> None:
    """Embed the texts whose digest the runs before ``run`` do not have. A repeated run overwrites its own part.

    ``embed`` adds the column ``embedding`` to rows with a text; the default model looks at each text alone.
    """
    embed = embed or (lambda df, c: hashed_embeddings(df, c, weighted=False))
    keyed = docs.where(F.col(text_col).isNotNull()).select("doc_id", text_col, content_digest(text_col).alias("digest"))
    known = stored_vectors(docs.sparkSession, path, before=run).select("digest")
    chosen = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(known, "digest", "left_anti")
    # (id, digest) names the text even where an id is repeated with another text
    texts = keyed.join(chosen, ["doc_id", "digest"], "left_semi").dropDuplicates(["digest"])
    embed(texts, text_col).select("digest", "embedding", F.lit(run).cast("bigint").alias("run")).write.mode("overwrite").parquet(part_path(path, run, run))


def with_vectors(docs: DataFrame, path: str, text_col: str = "content") -> DataFrame:
    """The documents with ``embedding`` and the ``run`` that made it (null where the text has none)."""
    keyed = docs.withColumn("_digest", content_digest(text_col))
    store = stored_vectors(docs.sparkSession, path).withColumnRenamed("digest", "_digest")
    return keyed.join(store, "_digest", "left").drop("_digest")
