"""Continuous index refresh: changed documents of each micro-batch are chunked, embedded and merged by key.

Two tables are kept by parts (``parts.py``). ``digests`` has a small row (doc_id, doc_hash, batch_id) for each change of a
document, without a hash where it was removed; merged parts keep the newest. ``chunks`` has the chunks with their batch;
merged parts keep those that the digests still name. A batch reads the digests to find what has changed and never older text,
and the index is the chunks whose (document, batch) is the document's newest digest.

A batch writes its chunks first and its digests last: chunks without digests are not in the index, so a batch that breaks
off between the two is invisible, and its repetition overwrites both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.chunking import bound_batches, explode_chunks, greedy_array
from corpusloom.operators.embedding import hashed_embeddings
from corpusloom.session import scratch_path
from corpusloom.streaming.parts import FAN, merge_parts, read_parts, write_part

INDEX_DDL = (
    "chunk_id string, doc_id bigint, chunk_index bigint, total_chunks bigint, content string, char_count bigint, "
    "embedding array<float>, doc_hash bigint, batch_id bigint"
)
DIGEST_DDL = "doc_id bigint, doc_hash bigint, batch_id bigint"


def newest_digests(digests: DataFrame) -> DataFrame:
    """One row per document: the one of its newest batch."""
    newest = digests.groupBy("doc_id").agg(F.max(F.struct("batch_id", "doc_hash")).alias("_row"))
    return newest.select("doc_id", F.col("_row.doc_hash").alias("doc_hash"), F.col("_row.batch_id").alias("batch_id"))


def live_chunks(chunks: DataFrame, digests: DataFrame) -> DataFrame:
    live = newest_digests(digests).where("doc_hash IS NOT NULL").select("doc_id", "batch_id")
    return chunks.join(live, ["doc_id", "batch_id"], "left_semi")


def index_state(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of the index."""
    chunks = read_parts(spark, f"{path}/chunks", INDEX_DDL)
    return live_chunks(chunks, read_parts(spark, f"{path}/digests", DIGEST_DDL)).select(*[c.split()[0] for c in INDEX_DDL.split(", ")])


def newest_versions(batch: DataFrame, version: str) -> DataFrame:
    """One row per document: the one with the greatest ``version`` (ties: the greatest content, null lowest)."""
    row = F.struct(version, "content")
    return batch.groupBy("doc_id").agg(F.max(row).alias("_row")).select("doc_id", F.col("_row.content").alias("content"))


def merge_batch(path: str, version: str | None = None, fan: int = FAN):
    """A ``foreachBatch`` function.

    With ``version``, only the newest row of each document in the batch counts. A document whose content is null or
    gives no chunk is removed.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bound_batches(spark)
        rows = newest_versions(batch, version) if version else batch
        parts = greedy_array(F.col("content"))
        known = newest_digests(read_parts(spark, f"{path}/digests", DIGEST_DDL, before=batch_id)).select("doc_id", F.col("doc_hash").alias("_known"))
        hashed = rows.withColumn("doc_hash", F.when(F.coalesce(F.size(parts), F.lit(0)) > 0, F.xxhash64("content")))
        changed = hashed.join(known, "doc_id", "left").where(~F.col("doc_hash").eqNullSafe(F.col("_known")))
        indexed = hashed_embeddings(explode_chunks(changed.where("doc_hash IS NOT NULL"), parts, ["doc_hash"]), "content", weighted=False)
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        write_part(indexed.select(*[c.split()[0] for c in INDEX_DDL.split(", ")][:-1], number), f"{path}/chunks", batch_id)
        write_part(changed.select("doc_id", "doc_hash", number), f"{path}/digests", batch_id)
        merge_parts(spark, f"{path}/digests", batch_id, DIGEST_DDL, newest_digests, fan)
        digests = read_parts(spark, f"{path}/digests", DIGEST_DDL, before=batch_id + 1)
        merge_parts(spark, f"{path}/chunks", batch_id, INDEX_DDL, lambda chunks: live_chunks(chunks, digests), fan)

    return merge


def sync_index(docs: DataFrame, path: str | None = None, checkpoint: str | None = None, version: str | None = None) -> DataFrame:
    """Run the refresh over all available input and return the merged index."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "index")
    checkpoint = checkpoint or scratch_path(spark, "index-checkpoint")
    q = docs.writeStream.foreachBatch(merge_batch(path, version)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return index_state(spark, path)
