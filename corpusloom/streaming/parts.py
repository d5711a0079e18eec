"""Tables that a stream writes as one part per micro-batch and merges from time to time.

A part is a folder named after the batches it covers, ``batches=first-last``. A repeated batch overwrites its own part, and a
part counts only once its success marker is there, so a lost driver leaves nothing half-written. Parts are merged in tiers:
the newest ``fan`` parts of about one width become one that covers their batches, and readers take the widest parts and leave out
what these cover. So after n batches a reader sees a few times log(n) parts, and a row is rewritten log(n) times, not n.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FAN = 4


def part_path(path: str, first: int, last: int) -> str:
    return f"{path}/batches={first}-{last}"


def finished_parts(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(first, last) of the finished parts, whatever the store; a folder that is not there has none."""
    files = spark._jvm.org.apache.hadoop.fs
    top = files.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    out = []
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("batches=") and fs.exists(files.Path(status.getPath(), "_SUCCESS")):
            first, last = name.removeprefix("batches=").split("-")
            out.append((int(first), int(last)))
    return out


def cover(parts: list[tuple[int, int]], before: int | None = None) -> list[tuple[int, int]]:
    """The widest parts that together hold every batch once (with ``before`` only batches under that number)."""
    out, done = [], -1
    for first, last in sorted(parts, key=lambda p: (p[0], -p[1])):
        if last > done and (before is None or last < before):
            out.append((first, last))
            done = last
    return out


def read_parts(spark: SparkSession, path: str, ddl: str, before: int | None = None) -> DataFrame:
    """The rows of all batches (under ``before``); columns that a part lacks are null."""
    found = cover(finished_parts(spark, path), before)
    if not found:
        return spark.createDataFrame([], ddl)
    return read_folders(spark, path, ddl, found)


def read_folders(spark: SparkSession, path: str, ddl: str, found: list[tuple[int, int]]) -> DataFrame:
    rows = spark.read.schema(ddl).option("basePath", path).parquet(*[part_path(path, *p) for p in found])
    return rows.select(*T.StructType.fromDDL(ddl).names)


def write_part(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(part_path(path, batch_id, batch_id))


def merge_parts(spark: SparkSession, path: str, batch_id: int, ddl: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
    """Merge the newest parts while the last ``fan`` of them are of one tier."""
    tier = lambda p: int(math.log(p[1] - p[0] + 1, fan) + 1e-9)
    while True:
        newest = cover(finished_parts(spark, path), batch_id + 1)[-fan:]
        if len(newest) < fan or len({tier(p) for p in newest}) > 1:
            return
        merge(read_folders(spark, path, ddl, newest)).write.mode("overwrite").parquet(part_path(path, newest[0][0], newest[-1][1]))


def drop_covered(spark: SparkSession, path: str) -> int:
    """Delete the parts that wider ones cover, when no reader uses them any more; returns how many."""
    parts = finished_parts(spark, path)
    old = sorted(set(parts) - set(cover(parts)))
    files = spark._jvm.org.apache.hadoop.fs
    for p in old:
        where = files.Path(part_path(path, *p))
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(old)
