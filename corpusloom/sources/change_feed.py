"""Changes between the snapshots of a table, as a data source for batch and stream.

``write_digests`` keeps of each snapshot only (key, digest of the content), dealt into buckets by key. The source
``snapshot_changes`` compares a bucket of one version with the same bucket of the version before, so a read is as many tasks
as buckets and versions, and nothing is shuffled. A stream's offset is the number of the version it has read up to.
Folders are opened with pyarrow on the executors, in any store that it reaches by URI.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "key bigint, action string, version bigint"
BUCKETS = 16


def write_digests(df: DataFrame, path: str, version: int, key: str, content: str, buckets: int = BUCKETS) -> None:
    """Write the digests of one version (numbered from 1). A null content has a digest of its own; null keys are left out."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.xxhash64(content), F.lit(0)).alias("digest"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    rows.repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")


class BucketChanges(InputPartition):
    def __init__(self, path: str, version: int, bucket: int):
        self.path, self.version, self.bucket = path, version, bucket


def open_store(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    if path.startswith("file:") and "://" not in path:
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def versions(path: str) -> list[int]:
    """Numbers of the finished snapshots."""
    from pyarrow import fs

    store, top = open_store(path)
    found = store.get_file_info(fs.FileSelector(top, allow_not_found=True))
    named = [(int(m[1]), x.path) for x in found if (m := re.fullmatch(r"version=(\d+)", x.base_name))]
    return sorted(v for v, p in named if store.get_file_info(f"{p}/_SUCCESS").type != fs.FileType.NotFound)


def bucket_digests(path: str, version: int, bucket: int):
    """(keys, digests) of a bucket, sorted by key."""
    import numpy as np
    import pyarrow.dataset as ds
    from pyarrow import fs

    store, top = open_store(f"{path}/version={version}/bucket={bucket}")
    if version < 1 or store.get_file_info(top).type == fs.FileType.NotFound:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = ds.dataset(top, filesystem=store, format="parquet").to_table(columns=["key", "digest"])
    keys, digests = (table.column(c).to_numpy() for c in ("key", "digest"))
    order = np.argsort(keys, kind="stable")
    return keys[order], digests[order]


def bucket_changes(path: str, version: int, bucket: int):
    """Record batches (key, action, version): what a version changed against the one before it."""
    import numpy as np
    import pyarrow as pa

    (old, was), (new, now) = bucket_digests(path, version - 1, bucket), bucket_digests(path, version, bucket)
    _, at_old, at_new = np.intersect1d(old, new, return_indices=True)
    changed = new[at_new[was[at_old] != now[at_new]]]
    for keys, action in ((np.setdiff1d(new, old), "insert"), (changed, "update"), (np.setdiff1d(old, new), "delete")):
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([action] * len(keys)), pa.array(np.full(len(keys), version))], names=["key", "action", "version"])


class ChangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.buckets = options["path"], int(options.get("buckets", BUCKETS))
        self.start, self.end = int(options.get("start", 0)), options.get("end")

    def partitions(self):
        return [BucketChanges(self.path, v, b) for v in versions(self.path) if v > self.start and (self.end is None or v <= int(self.end)) for b in range(self.buckets)]

    def read(self, part):
        return bucket_changes(part.path, part.version, part.bucket) if part else iter(())  # no partitions are one without a bucket


class ChangeStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.buckets, self.start = options["path"], int(options.get("buckets", BUCKETS)), int(options.get("start", 0))

    def initialOffset(self):
        return {"version": self.start}

    def latestOffset(self):
        return {"version": max([self.start, *versions(self.path)])}

    def partitions(self, start, end):
        return [BucketChanges(self.path, v, b) for v in range(start["version"] + 1, end["version"] + 1) for b in range(self.buckets)]

    def read(self, part):
        return bucket_changes(part.path, part.version, part.bucket) if part else iter(())  # no partitions are one without a bucket


class SnapshotChanges(DataSource):
    """Options: ``path``, ``start`` (the version already known, 0), ``end`` (batch only), ``buckets`` (as written)."""

    @classmethod
    def name(cls):
        return "snapshot_changes"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ChangeReader(self.options)

    def streamReader(self, schema):
        return ChangeStream(self.options)


def change_feed(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """Rows (key, action, version) of the snapshots under ``path``."""
    spark.dataSource.register(SnapshotChanges)
    reader = (spark.readStream if stream else spark.read).format("snapshot_changes").option("path", path)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()
