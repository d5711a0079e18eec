"""Stored inverted file for vector search: vectors written by cell, searched by compact codes, re-ranked exactly.

``write_cells`` puts each vector into the folder of its nearest centre, with a code of one byte a component and the distance
between the vector and what the code stands for. A search reads the folders of the probed cells only, and there first
the codes: they give a lower and an upper bound of every cosine, so a task keeps just the rows that can still be among the best k
it has seen. After the bounds of all tasks are compared, the vectors of the few rows left are read and scored exactly. Within
the probed cells the result is that of a full scan.

Queries go in blocks of a fixed number of rows, each broadcast for one scan; centres are a parameter's worth of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.topk import vectors_of

QUERY_BLOCK = 2_000
SCAN_ROWS = 4_096
LEVELS = 127
SLACK = 1e-6  # what rounding to six digits and float sums can move a cosine


def fixed_centres(vectors: DataFrame, cells: int) -> np.ndarray:
    """The vectors with the smallest hash of their id, in that order: the same centres for the same table. At most ``cells`` rows."""
    key, emb = vectors.columns[:2]
    rows = vectors.where(F.col(emb).isNotNull()).orderBy(F.sha2(F.col(key).cast("string"), 256), key).limit(cells).toArrow()
    return vectors_of(rows.column(1))


def _nearest(unit: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n centres of largest cosine (nine digits), ties to the lower number."""
    return np.argsort(-np.round(unit @ centres.T, 9), axis=1, kind="stable")[:, :n]


def write_cells(vectors: DataFrame, centres: np.ndarray, path: str) -> None:
    """Write (id, embedding, code, gap) by cell, sorted by id. Null vectors match nothing and are not stored."""
    key, emb = vectors.columns[:2]

    def run(batches):
        for batch in batches:
            unit = vectors_of(batch.column(1))
            code = np.rint(unit * LEVELS).astype(np.int8)
            gap = np.linalg.norm(unit - code / LEVELS, axis=1)
            codes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(unit.shape[1]), len(unit), [None, pa.py_buffer(np.ascontiguousarray(code))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, pa.array(gap), pa.array(_nearest(unit, centres, 1)[:, 0], pa.int32())], names=["id", "embedding", "code", "gap", "cell"])

    celled = vectors.where(F.col(emb).isNotNull()).select(key, emb).mapInArrow(run, "id bigint, embedding array<float>, code binary, gap double, cell int")
    # a large cell is written by many tasks: rows are dealt by (cell, id) ranges, not by cell
    celled.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").write.mode("overwrite").partitionBy("cell").parquet(path)


def cells(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """The stored rows of some cells; other folders are not read."""
    ddl = "id bigint, embedding array<float>, code binary, gap double, cell int"
    return spark.read.schema(ddl).parquet(path).where(F.col("cell").isin(wanted))


def search_cells(spark: SparkSession, path: str, centres: np.ndarray, queries: DataFrame, k: int, probes: int, exclude_self: bool = True, block: int = QUERY_BLOCK) -> DataFrame:
    """Rows (query_id, hit_id, score, rank): the best k of the ``probes`` cells nearest to each query."""
    qid, vec = queries.columns[:2]
    asked = queries.where(F.col(vec).isNotNull()).select(F.col(qid).alias("query_id"), F.col(vec).alias("query_vec"))
    blocks = max(1, -(-asked.count() // block))
    parts = []
    for b in range(blocks):
        batch = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).toArrow()
        if batch.num_rows:
            parts.append(_search_block(spark, path, centres, batch, k, probes, exclude_self))
    if not parts:
        return spark.createDataFrame([], "query_id bigint, hit_id bigint, score double, rank bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _search_block(spark, path, centres, batch, k, probes, exclude_self):
    ids, unit = batch.column(0).to_numpy(), vectors_of(batch.column(1))
    near = _nearest(unit, centres, probes)
    wanted = sorted(set(near.ravel().tolist()))  # at most one number a cell
    askers = {c: np.flatnonzero((near == c).any(1)) for c in wanted}
    held = spark.sparkContext.broadcast((ids, unit, askers))

    def run(batches):
        ids, unit, askers = held.value
        found = [[] for _ in ids]
        floors = np.full(len(ids), -np.inf)
        for whole in batches:
            for at in range(0, whole.num_rows, SCAN_ROWS):
                rows = whole.slice(at, SCAN_ROWS)
                row_ids, gap, cell = (rows.column(c).to_numpy() for c in ("id", "gap", "cell"))
                code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.int8).reshape(len(row_ids), -1) / LEVELS
                for c in np.unique(cell):
                    mine, here = askers.get(int(c), ()), np.flatnonzero(cell == c)
                    if not len(mine):
                        continue
                    score = code[here] @ unit[mine].T
                    low, high = score - gap[here][:, None] - SLACK, score + gap[here][:, None] + SLACK
                    if exclude_self:
                        own = row_ids[here][:, None] == ids[mine][None]
                        low[own] = high[own] = -np.inf
                    for j, q in enumerate(mine):
                        keep = np.flatnonzero((high[:, j] >= floors[q]) & (high[:, j] > -np.inf))
                        if len(keep):
                            found[q].append((row_ids[here][keep], cell[here][keep], low[keep, j], high[keep, j]))
                            if sum(len(p[0]) for p in found[q]) > 8 * k:
                                found[q] = [_best(found[q], k)]
                                floors[q] = np.partition(found[q][0][2], -k)[-k] if len(found[q][0][2]) >= k else -np.inf
        rows = [(np.full(len(x[0]), ids[q]), *x) for q, p in enumerate(found) if p for x in [_best(p, k)]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["query_id", "id", "cell", "low", "high"])

    codes = cells(spark, path, wanted)
    bounds = codes.select("id", "cell", "code", "gap").mapInArrow(run, "query_id bigint, id bigint, cell int, low double, high double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low"), "id"))
    floor = F.max(F.when(F.col("_r") == k, F.col("low"))).over(Window.partitionBy("query_id"))
    left = bounds.withColumn("_r", rank).withColumn("_floor", floor).where("_floor IS NULL OR high >= _floor").select("query_id", "id", "cell")
    pairs = codes.select("id", "cell", "embedding").join(left, ["cell", "id"])

    def exact(batches):
        ids, unit, _ = held.value
        order = np.argsort(ids)
        for rows in batches:
            q = order[np.searchsorted(ids, rows.column("query_id").to_numpy(), sorter=order)]
            score = np.einsum("ij,ij->i", vectors_of(rows.column("embedding")), unit[q]) if rows.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([rows.column("query_id"), rows.column("id"), pa.array(np.round(score, 6))], names=["query_id", "hit_id", "score"])

    scored = pairs.select("query_id", "id", "embedding").mapInArrow(exact, "query_id bigint, hit_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "hit_id")
    return scored.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= k)


def _best(parts, k):
    """The rows whose upper bound reaches the k-th best lower bound."""
    rows = [np.concatenate(c) for c in zip(*parts)]
    if len(rows[0]) <= k:
        return tuple(rows)
    keep = rows[3] >= np.partition(rows[2], -k)[-k]
    return tuple(c[keep] for c in rows)
