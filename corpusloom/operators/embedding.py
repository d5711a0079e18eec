"""Text embedding and vector checks. A real model plugs in as an iterator function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

# Texts up to this length get no vector, and the model's sub-batch size.
MIN_CHARS = 10
SUB_BATCH = 32


def hashed_embeddings(df: DataFrame, text_col: str, dim: int = 256, out: str = "embedding", weighted: bool = True) -> DataFrame:
    """Default model: hashed term counts, weighted by inverse document frequency, unit length.

    Without ``weighted`` a vector depends on its own text alone, as a stream needs.

    Texts that are NULL or at most ``MIN_CHARS`` long get NULL, so the row count never changes.
    """
    usable = F.length(text_col) > MIN_CHARS
    toks = F.when(usable, tx.tokens(F.lower(text_col))).otherwise(F.array().cast("array<string>"))
    counted = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim).transform(df.withColumn("_tok", toks))
    scaled = IDF(inputCol="_tf", outputCol="_idf").fit(counted).transform(counted) if weighted else counted.withColumn("_idf", F.col("_tf"))
    unit = Normalizer(inputCol="_idf", outputCol="_unit").transform(scaled)
    vector = F.when(usable, vector_to_array("_unit", dtype="float32"))
    return unit.withColumn(out, vector).drop("_tok", "_tf", "_idf", "_unit")


def model_embeddings(
    df: DataFrame, text_col: str, make_model: Callable[[], Callable[[list[str]], list[list[float]]]], out: str = "embedding", sub_batch: int = SUB_BATCH
) -> DataFrame:
    """Hook for a model: built once per task, called on sub-batches of usable texts only."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            values = texts.tolist()
            usable = [i for i, t in enumerate(values) if isinstance(t, str) and len(t) > MIN_CHARS]
            vectors: list[list[float] | None] = [None] * len(values)
            for at in range(0, len(usable), sub_batch):
                part = usable[at : at + sub_batch]
                for i, vector in zip(part, model([values[i] for i in part])):
                    vectors[i] = vector
            yield pd.Series(vectors, dtype=object)

    # pandas_udf reads the kind from evaluated hints, which this module postpones.
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(run, "array<float>")(text_col))


def pending_texts(docs: DataFrame, indexed: DataFrame, text_col: str = "content") -> DataFrame:
    """One representative per distinct text that has no vector yet: (digest, doc_id, copies).

    Copies are counted on the map side, so a text that fills a third of the corpus stays cheap.
    """
    digest = F.sha2(text_col, 256)
    distinct = docs.groupBy(digest.alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    return distinct.join(indexed.select(digest.alias("digest")).distinct(), "digest", "left_anti")


def vector_health(vectors: DataFrame, category: str = "label", expected_dim: int | None = None) -> DataFrame:
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    dim = F.when(F.col("embedding").isNotNull(), F.size("embedding"))
    per_row = vectors.select(category, dim.alias("dim"), norm.alias("norm"))
    aggs = [
        F.count(F.lit(1)).alias("vectors"),
        F.count(F.when(F.col("dim").isNull(), 1)).alias("nulls"),
        F.min("dim").alias("min_dim"),
        F.max("dim").alias("max_dim"),
        F.min("norm").alias("min_norm"),
        F.max("norm").alias("max_norm"),
    ]
    if expected_dim:
        aggs.append(F.count(F.when(F.col("dim") != expected_dim, 1)).alias("wrong_dim"))
    return per_row.groupBy(category).agg(*aggs)
