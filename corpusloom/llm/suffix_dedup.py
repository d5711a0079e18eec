"""Removal of repeated byte strings by distributed prefix doubling.

Suffixes are compared from sampled positions: anchors, the minima of hashed 16-byte strings over each 190 neighbouring
places. Anchors depend on the text around them only, so two equal strings of 400 bytes hold the same ones, at least two.
The bytes from an anchor to the next (and 16 more) are a unit, the unit's hash its rank. Spark sorts the ranks; positions
whose rank is unique are out. Then pairs of ranks at offsets 1, 2, 4, ... are ranked and sorted in the same way, until a
position is unique or its unit is longer than the threshold. So the sorts shrink fast, and only repeated text goes on.

Ends are found to the byte. The places where a string of 400 bytes can start fall into intervals that have the same first and
last anchor. An interval survives if the ranks of all its units do. Intervals are sorted by (hash between the anchors,
hash of all their bytes): where all bytes are equal, each string of the interval is repeated. Where only the part between
the anchors is equal, the hashes of the single 400-byte strings are counted; one interval stands for all equal ones.

Sorts are range partitioned with the document as the last key, so equal ranks of a third of all rows spread over many
tasks, and each batch of sorted rows is judged alone: rows at its ends pass as not unique, which costs a later test but no
result. Equality is equality of 64-bit hashes.

Defined cases: a null text is empty; texts shorter than the threshold lose nothing; repeated rows are documents of their own
(their texts repeat, so they lose what is long enough); null ids are allowed; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import hashing as H
from corpusloom.llm.common import discard, materialise, write_once
from corpusloom.llm.decontamination import text_bytes

LENGTH = 400
GRAM, PLACES = 16, 190
ROWS = 50_000


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix hashes, anchor places, number of the anchor that rules each start): rightmost minimum of PLACES 16-grams."""
    data = np.frombuffer(text, np.uint8)
    sums = H.prefix_hash(data)
    n = len(data) - GRAM + 1
    at = np.arange(n)
    low = np.uint64(0xFFFFFF)
    with np.errstate(over="ignore"):
        value = H.mix((sums[GRAM:] - sums[:n]) * H.powers(len(data))[1][:n])
    least = (value & ~low) | (~at.astype(np.uint64) & low)
    width = 1
    while 2 * width <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if PLACES > width:
        least = np.minimum(least[: width - PLACES], least[PLACES - width :])
    start = np.arange(len(least))
    place = start + ((((~least & low).astype(np.int64)) - start) & 0xFFFFFF)
    change = np.diff(place, prepend=-1) != 0
    return sums, place[change], np.cumsum(change) - 1


def unit_rows(docs: DataFrame) -> DataFrame:
    """(id, th, i, len, rank): the units of texts of at least LENGTH bytes."""

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for d, text in enumerate(text_bytes(batch.column("text"))):
                if len(text) < LENGTH:
                    continue
                sums, place, _ = anchors(text)
                m = len(place) - 1
                if m > 0:
                    held.append((np.full(m, d), np.arange(m), np.diff(place), H.span_hash(sums, place[:-1], place[1:] + GRAM).view(np.int64)))
                    size += m
                if size >= ROWS:
                    yield emit(batch, held)
                    held, size = [], 0
            if held:
                yield emit(batch, held)

    def emit(batch, held):
        d, i, length, rank = (np.concatenate(c) for c in zip(*held))
        ids, th = batch.column("id").take(pa.array(d)), batch.column("th").take(pa.array(d))
        return pa.RecordBatch.from_arrays([ids, th, pa.array(i, pa.int32()), pa.array(length, pa.int32()), pa.array(rank)], names=["id", "th", "i", "len", "rank"])

    return docs.mapInArrow(run, "id bigint, th bigint, i int, len int, rank bigint")


def repeated(rows: DataFrame) -> DataFrame:
    """The rows whose rank is not unique, from a sort by rank; rows at the ends of a sorted batch may pass wrongly."""

    def run(batches):
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            keep = np.ones(len(rank), bool)
            if len(rank) > 2:
                same = rank[1:] == rank[:-1]
                keep[1:-1] = same[1:] | same[:-1]
            yield batch.filter(pa.array(keep))

    spread = rows.repartitionByRange("rank", "id", "th", "i").sortWithinPartitions("rank")
    return spread.mapInArrow(run, rows.schema)


def doubled_ranks(units: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, th, i, k): positions whose unit of 2**k is not unique, for all k up to the threshold."""
    spark = units.sparkSession
    units, path = write_once(units, "suffix-units")
    now = materialise(repeated(units), "suffix-ranks")
    discard(spark, path)
    levels, k = now.select("id", "th", "i", F.lit(0).alias("k")), 0
    while True:
        offset = 1 << k
        ahead = Window.partitionBy("id", "th").orderBy("i").rangeBetween(offset, offset)
        # equal rows of one document have equal ranks, so any of them will do
        pairs = now.where(F.col("len") < length).select(
            "id", "th", "i", (F.col("len") + F.min("len").over(ahead)).alias("len"), F.xxhash64("rank", F.min("rank").over(ahead)).alias("rank")
        )
        pairs, path = write_once(pairs.where("len IS NOT NULL"), "suffix-pairs")
        if pairs.isEmpty():
            return levels
        k += 1
        now = materialise(repeated(pairs), "suffix-ranks")
        discard(spark, path)
        levels = levels.union(now.select("id", "th", "i", F.lit(k).alias("k")))


def intervals(text: bytes, levels: np.ndarray | None, length: int = LENGTH) -> list[np.ndarray]:
    """[inner, outer, low, high] of the intervals of starts whose units are all repeated. levels: (i, k) rows."""
    empty = [np.zeros(0, np.int64)] * 4
    if levels is None or len(text) < length:
        return empty
    sums, place, number = anchors(text)
    reach = length - PLACES - GRAM + 1
    first, last = number[: len(text) - length + 1], number[reach : len(text) - length + 1 + reach]
    level = np.full(len(place) + 1, -1)
    np.maximum.at(level, levels[:, 0], levels[:, 1])
    low = np.flatnonzero((np.diff(first, prepend=-1) != 0) | (np.diff(last, prepend=-1) != 0))
    high = np.append(low[1:], len(first)) - 1
    a, b = first[low], last[low]
    k = np.frexp((b - a).astype(np.float64))[1] - 1
    good = (level[a] >= k) & (level[b - (1 << k)] >= k)
    low, high, a, b = low[good], high[good], a[good], b[good]
    inner = H.span_hash(sums, place[a], place[b] + GRAM)
    return [inner.view(np.int64), H.span_hash(sums, low, high + length).view(np.int64), low, high]


CERTAIN, SINGLE, SPEAKER = 1, 2, 3
AGAIN, EDGE = 1, 2
INTERVALS = "array<struct<inner:bigint,outer:bigint,low:int,high:int>>"


def with_intervals(docs: DataFrame, levels: DataFrame) -> DataFrame:
    """Every document with its size, the hash of all its bytes and its intervals; the text only where it has intervals."""
    per_doc = levels.groupBy("id", "th").agg(F.collect_list(F.struct("i", "k")).alias("levels"))
    both = docs.join(materialise(per_doc, "suffix-levels"), ["id", "th"], "left")
    kind = pa.list_(pa.struct([("inner", pa.int64()), ("outer", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))

    def run(batches):
        for batch in batches:
            parts, sizes, hashes, texts = [], [], [], []
            levels_of = batch.column("levels")
            for d, text in enumerate(text_bytes(batch.column("text"))):
                flat = levels_of[d].values
                pairs = None if flat is None else np.stack([flat.field(c).to_numpy() for c in (0, 1)], 1)
                parts.append(intervals(text, pairs))
                sizes.append(len(text))
                hashes.append(hashlib.sha256(text).hexdigest())
                texts.append(text if len(parts[-1][0]) else None)
            offsets = pa.array(np.cumsum([0] + [len(p[0]) for p in parts]), pa.int32())
            columns = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(4)]
            fields = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind.value_type)], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(hashes), pa.array(texts, pa.binary()), pa.ListArray.from_arrays(offsets, fields)],
                names=["id", "th", "doc_id", "n_bytes", "whole", "text", "intervals"],
            )

    return both.select("id", "th", "doc_id", "text", "levels").mapInArrow(run, f"id bigint, th bigint, doc_id bigint, n_bytes bigint, whole string, text binary, intervals {INTERVALS}")


def judged_intervals(table: DataFrame) -> DataFrame:
    """(id, th, low, high, kind): certain intervals, single ones to be tested, and certain ones that speak for all equal ones."""

    def run(batches):
        for batch in batches:
            inner, outer = batch.column("inner").to_numpy(), batch.column("outer").to_numpy()
            n = len(inner)
            if not n:
                continue
            new_inner = np.diff(inner, prepend=inner[0] ^ 1) != 0
            new_run = new_inner | (np.diff(outer, prepend=outer[0] ^ 1) != 0)
            run_of, group_of = np.cumsum(new_run) - 1, np.cumsum(new_inner) - 1
            size = np.bincount(run_of)
            first = np.flatnonzero(new_run)
            others = np.bincount(group_of[first]) > 1
            others[[0, -1]] = True  # a group at the end of the batch may have more elsewhere
            alone, open_ = size[run_of] == 1, others[group_of]
            kind = np.where(alone, np.where(open_, SINGLE, 0), CERTAIN)
            speaks = first[(size > 1) & others[group_of[first]]]
            kind[speaks] = SPEAKER
            keep = pa.array(kind > 0)
            columns = [batch.column(c).filter(keep) for c in ("id", "th", "low", "high")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kind[kind > 0], pa.int32())], names=["id", "th", "low", "high", "kind"])

    rows, path = write_once(table.select("id", "th", F.explode("intervals").alias("x")).select("id", "th", "x.*"), "suffix-intervals")
    spread = rows.repartitionByRange("inner", "outer", "id", "th", "low").sortWithinPartitions("inner", "outer")
    judged = materialise(spread.mapInArrow(run, "id bigint, th bigint, low int, high int, kind int"), "suffix-judged")
    discard(table.sparkSession, path)
    return judged


def string_hashes(table: DataFrame, judged: DataFrame, length: int = LENGTH) -> DataFrame:
    """(w, id, th, s): hashes of the 400-byte strings of intervals to be tested; s is null for those that only speak.

    The intervals of repeated rows are equal, and each of the rows gives the strings of all of them, so each stands once a row.
    """
    asked = judged.where(F.col("kind") != CERTAIN).groupBy("id", "th").agg(F.collect_set(F.struct("low", "high", "kind")).alias("part"))
    both = table.where("text IS NOT NULL").select("id", "th", "text").join(materialise(asked, "suffix-asked"), ["id", "th"])

    def run(batches):
        for batch in batches:
            part = batch.column("part")
            for d, text in enumerate(text_bytes(batch.column("text"))):
                sums = H.prefix_hash(np.frombuffer(text, np.uint8))
                low, high, kind = (part[d].values.field(c).to_numpy() for c in range(3))
                n = high - low + 1
                s = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                for at in range(0, len(s), ROWS):
                    now = s[at : at + ROWS]
                    single = np.repeat(kind, n)[at : at + ROWS] == SINGLE
                    ids = [pa.array(np.full(len(now), batch.column(c)[d].as_py(), np.int64)) for c in ("id", "th")]
                    yield pa.RecordBatch.from_arrays([pa.array(H.span_hash(sums, now, now + length).view(np.int64)), *ids, pa.array(now, pa.int32(), mask=~single)], names=["w", "id", "th", "s"])

    return both.mapInArrow(run, "w bigint, id bigint, th bigint, s int")


def repeated_strings(strings: DataFrame, tasks: int | None = None) -> DataFrame:
    """(id, th, low, high): the tested strings whose hash stands more than once, from one sort by hash.

    Equal hashes are neighbours in a task. A hash at the start or end of a task may go on in the next one, so each task
    also tells its first and last row; these two rows a task are compared among themselves.
    """

    def run(batches):
        last, was, seen = None, False, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if not seen:
                yield told(batch.slice(0, 1), np.array([EDGE]))
            seen += batch.num_rows
            rows = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            w = rows.column("w").to_numpy()
            same = w[1:] == w[:-1]
            again = np.append(same, False) | np.append(was, same)
            was, last = bool(again[-1]), rows.slice(len(w) - 1)
            at = np.flatnonzero(again[:-1])
            yield told(rows.take(pa.array(at)), np.full(len(at), AGAIN))
        if seen > 1:  # a single row is its task's first and last, told once
            yield told(last, np.array([EDGE]))
            if was:
                yield told(last, np.array([AGAIN]))

    def told(rows, kind):
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(kind, pa.int32())], names=[*rows.schema.names, "kind"])

    spread = strings.select("w", "id", "th", "s").repartitionByRange(*([tasks] if tasks else []), "w", "id", "th", "s").sortWithinPartitions("w")
    found = materialise(spread.mapInArrow(run, "w bigint, id bigint, th bigint, s int, kind int"), "suffix-again")
    edges = found.where(F.col("kind") == EDGE)
    over = edges.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w")
    hits = found.where(F.col("kind") == AGAIN).drop("kind").unionByName(edges.drop("kind").join(over, "w", "left_semi"))
    return hits.where("s IS NOT NULL").select("id", "th", F.col("s").alias("low"), F.col("s").alias("high"))


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` the bytes that stay."""
    keyed = docs.select(F.coalesce("doc_id", F.lit(-1)).cast("bigint").alias("id"), F.xxhash64("text").alias("th"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    table = materialise(with_intervals(keyed, doubled_ranks(unit_rows(keyed.select("id", "th", "text")))), "suffix-docs")
    judged = judged_intervals(table)
    strings, path = write_once(string_hashes(table, judged), "suffix-strings")
    hits = repeated_strings(strings)
    covered = judged.where(F.col("kind") != SINGLE).select("id", "th", "low", "high").union(hits)
    covered = materialise(covered.groupBy("id", "th").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "suffix-covered")
    discard(docs.sparkSession, path)

    def run(batches):
        for batch in batches:
            removed, spans, hashes, kept = [], [], batch.column("whole").to_pylist(), []
            for d in range(batch.num_rows):
                flat = batch.column("spans")[d].values
                text = batch.column("text")[d].as_buffer()
                if flat is None or text is None:
                    removed.append(0)
                    spans.append(0)
                    kept.append(None)
                    continue
                data = np.frombuffer(text, np.uint8)
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, flat.field(0).to_numpy(), 1)
                np.add.at(edge, flat.field(1).to_numpy() + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(len(H.runs(gone)[0]))
                kept.append(data[~gone].tobytes())
                hashes[d] = hashlib.sha256(kept[-1]).hexdigest()
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hashes, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())] if keep_text else columns, names=[*names, "kept"] if keep_text else names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep_text else "")
    return table.drop("intervals").join(covered, ["id", "th"], "left").mapInArrow(run, schema)
