"""Exact top-k of a corpus for a batch of queries, without emitting query-document pairs.

Each task scores its part of the corpus against the query batch, block by block, and keeps only ``k``
rows per query. What is shuffled is ``tasks * queries * k`` small rows, whatever the score is.

The query batch is broadcast only after its size is checked. A larger batch is cut into blocks: both
sides get a block number, each (query block, corpus block) pair meets in one cogroup of bounded size,
and the same scorer runs there.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from typing import Protocol

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_BROADCAST_QUERIES = 2_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
CORPUS_BLOCK_ROWS = 200_000
MATRIX_CELLS = 8_000_000

HIT_SCHEMA = "query_id bigint, hit_id bigint, score double"
HIT_ARROW = pa.schema([("query_id", pa.int64()), ("hit_id", pa.int64()), ("score", pa.float64())])


class Scorer(Protocol):
    """Scores a corpus batch against the query batch it was made from.

    ``score`` returns a (rows, queries) float array with ``-inf`` where a row may not be returned.
    ``slice_rows`` bounds the rows per call.
    """

    slice_rows: int

    def score(self, batch: pa.RecordBatch | pa.Table) -> np.ndarray: ...


class TopK:
    """Best ``k`` (score, id) per query seen so far; higher score first, then lower id."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * len(query_ids)
        self.scores: list[np.ndarray] = [np.empty(0)] * len(query_ids)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for q in range(len(self.query_ids)):
            col = scores[:, q]
            floor = self.scores[q][-1] if len(self.scores[q]) == self.k else -np.inf
            keep = np.flatnonzero((col > -np.inf) & (col >= floor))
            if len(keep) > self.k:
                kth = np.partition(col[keep], len(keep) - self.k)[len(keep) - self.k]
                keep = keep[col[keep] >= kth]
            if not len(keep):
                continue
            all_ids = np.concatenate([self.ids[q], ids[keep]])
            all_scores = np.concatenate([self.scores[q], col[keep]])
            best = np.lexsort((all_ids, -all_scores))[: self.k]
            self.ids[q], self.scores[q] = all_ids[best], all_scores[best]

    def table(self) -> pa.Table:
        counts = [len(x) for x in self.ids]
        cat = lambda parts, dtype: np.concatenate(parts) if parts else np.empty(0, dtype)
        return pa.table(
            [np.repeat(self.query_ids, counts), cat(self.ids, np.int64), cat(self.scores, np.float64)], schema=HIT_ARROW
        )


def _feed(top: TopK, scorer: Scorer, batch: pa.RecordBatch | pa.Table) -> None:
    for at in range(0, batch.num_rows, scorer.slice_rows):
        part = batch.slice(at, scorer.slice_rows)
        top.add(part.column(0).to_numpy(zero_copy_only=False), scorer.score(part))


def top_hits(
    corpus: DataFrame,
    queries: DataFrame,
    make_scorer: Callable[[pa.Table], Scorer],
    k: int,
    max_broadcast_queries: int = MAX_BROADCAST_QUERIES,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    corpus_block_rows: int = CORPUS_BLOCK_ROWS,
) -> DataFrame:
    """Rows (query_id, hit_id, score, rank). Column 1 of each input is its bigint id."""
    spark = corpus.sparkSession
    batch = queries.limit(max_broadcast_queries + 1).toArrow()
    bounded = batch.num_rows <= max_broadcast_queries and batch.nbytes <= max_broadcast_bytes
    if bounded:
        shared = spark.sparkContext.broadcast(batch)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = shared.value
            top, scorer = TopK(table.column(0).to_numpy(), k), make_scorer(table)
            for b in batches:
                _feed(top, scorer, b)
            yield from top.table().to_batches()

        partial = corpus.mapInArrow(scan, HIT_SCHEMA)
    else:
        q_blocks = -(-queries.count() // max_broadcast_queries)
        c_blocks = max(1, -(-corpus.count() // corpus_block_rows))
        qid, cid = queries.columns[0], corpus.columns[0]
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        q = queries.withColumn("_qb", F.pmod(F.xxhash64(qid), F.lit(q_blocks)).cast("int")).withColumn("_cb", every(c_blocks))
        c = corpus.withColumn("_cb", F.pmod(F.xxhash64(cid), F.lit(c_blocks)).cast("int")).withColumn("_qb", every(q_blocks))

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return HIT_ARROW.empty_table()
            table = left.drop_columns(["_qb", "_cb"]).combine_chunks()
            top = TopK(table.column(0).to_numpy(), k)
            _feed(top, make_scorer(table), right.drop_columns(["_qb", "_cb"]))
            return top.table()

        partial = q.groupBy("_qb", "_cb").cogroup(c.groupBy("_qb", "_cb")).applyInArrow(meet, HIT_SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "hit_id")
    ranked = (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )
    # At most max_broadcast_queries * k rows of 32 bytes, so later joins need not shuffle the corpus.
    return F.broadcast(ranked) if bounded else ranked


def vectors_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list<float> column without nulls as a float64 matrix of unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    mat = flat.reshape(len(column), -1)
    norm = np.linalg.norm(mat, axis=1, keepdims=True)
    return mat / np.where(norm == 0, 1.0, norm)


class CosineScorer:
    """Cosine of vectors, rounded to ``digits`` so that equal vectors tie.

    With a category column on both sides only rows of the query's own category are scored.
    """

    def __init__(self, table: pa.Table, filtered: bool = False, exclude_self: bool = False, floor: float | None = None, digits: int = 6):
        self.ids = table.column(0).to_numpy()
        self.mat = vectors_of(table.column(1))
        self.cats = table.column(2).to_numpy() if filtered else None
        self.exclude_self, self.floor, self.digits = exclude_self, floor, digits
        self.slice_rows = max(64, MATRIX_CELLS // max(1, len(self.ids)))

    def score(self, batch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        rows = vectors_of(batch.column(1))
        if self.cats is None:
            out = rows @ self.mat.T
        else:
            cats = batch.column(2).to_numpy(zero_copy_only=False)
            out = np.full((len(ids), len(self.ids)), -np.inf)
            for cat in np.unique(self.cats):
                at, to = np.flatnonzero(cats == cat), np.flatnonzero(self.cats == cat)
                if len(at):
                    out[np.ix_(at, to)] = rows[at] @ self.mat[to].T
        finite = np.isfinite(out)
        out[finite] = np.round(out[finite], self.digits)
        if self.floor is not None:
            out[out < self.floor] = -np.inf
        if self.exclude_self:
            out[ids[:, None] == self.ids[None, :]] = -np.inf
        return out


class TermScorer:
    """Substring hits of query terms in a document's tokens.

    A term has no whitespace, so it occurs in a text exactly when it occurs in one of its tokens. The
    distinct tokens of a slice are scanned once for all terms together. Query table: id, terms,
    divisor. Corpus batch: id, distinct lower-case content tokens, optional title tokens.
    """

    def __init__(self, table: pa.Table, title_weight: float = 0.0, positive_only: bool = True, any_hit: float | None = None, digits: int = 6):
        lists = table.column(1).to_pylist()
        index = {t: i for i, t in enumerate(sorted({t for ts in lists for t in ts}))}
        self.finder = ahocorasick.Automaton()
        for term, i in index.items():
            self.finder.add_word(term, i)
        self.finder.make_automaton()
        self.weight = np.zeros((max(1, len(index)), len(lists)), np.float32)
        for q, ts in enumerate(lists):
            for t in ts:
                self.weight[index[t], q] += 1
        self.divisor = table.column(2).to_numpy().astype(np.float64)
        self.title_weight, self.positive_only, self.any_hit, self.digits = title_weight, positive_only, any_hit, digits
        self.slice_rows = max(64, MATRIX_CELLS // max(self.weight.shape))

    def _hits(self, column) -> np.ndarray:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        offsets = column.offsets.to_numpy()
        coded = column.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        vocab = coded.dictionary.to_pylist()
        out = np.zeros((len(column), len(self.weight)), np.float32)
        if not vocab or not len(self.finder):
            return out
        found = np.fromiter(itertools.chain.from_iterable(self.finder.iter("\n".join(vocab))), np.int64).reshape(-1, 2)
        ends = np.cumsum([len(t) + 1 for t in vocab])
        token_of = np.searchsorted(ends, found[:, 0], side="right")
        counts = np.bincount(token_of, minlength=len(vocab))
        starts = np.cumsum(counts) - counts
        codes = coded.indices.to_numpy()
        n = counts[codes]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row_of_token = np.repeat(np.arange(len(column)), np.diff(offsets))
        out[np.repeat(row_of_token, n), found[np.repeat(starts[codes], n) + within, 1]] = 1
        return out

    def score(self, batch):
        out = (self._hits(batch.column(1)) @ self.weight).astype(np.float64)
        if self.title_weight:
            out += self.title_weight * (self._hits(batch.column(2)) @ self.weight)
        if self.any_hit is not None:
            return np.where(out > 0, self.any_hit, -np.inf)
        out = np.round(out / self.divisor[None, :], self.digits)
        if self.positive_only:
            out[out <= 0] = -np.inf
        return out
