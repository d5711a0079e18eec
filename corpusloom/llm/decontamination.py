"""Benchmark decontamination with an FM-index per training shard.

Test phrases are windows of 10 consecutive words of a benchmark item (a shorter item is one window). A shard is a batch
of documents in a task. Its words become symbols; words that no test phrase holds become breaks, and stretches shorter
than every phrase they could hold are left out, because no occurrence can lie there. The FM-index of what remains
(suffix order by prefix doubling, Burrows-Wheeler transform in a wavelet matrix with rank directories, every eighth text
position sampled) is searched backwards with all phrases at once, occurrences are located by walking to the next sampled
position, and overlapping occurrences merge into removal spans. A document never spans shards, so there is no shuffle.

The benchmark is read in blocks of bounded size; each block is broadcast and searched in a pass of its own over the
batch, chained in one stage, so the benchmark may be larger than a task's memory. Phrases are compared by 64-bit hashes
of their words.

Defined cases: a null text has no words and keeps its null; items that are null or hold no word have no phrase; a null
item id is named "null", rows of an equal item id are one item; repeated documents are judged alike; an empty benchmark
leaves every document clean. Added columns replace input columns of the same name; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import hashing as H
from corpusloom.llm.common import batches_of, fresh, sha256_hex

WINDOW_WORDS = 10
BLOCK_BYTES = 32 << 20  # benchmark text in one broadcast
SHARD_SYMBOLS = 1 << 20  # symbols in one index (a longer document makes a longer index)
SAMPLE = 8
SPANS = "array<struct<start:bigint,stop:bigint>>"


class BitVector:
    """Bits with constant-time rank: packed 64-bit words and the count in front of each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of each position ``i``."""
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Symbols by bit levels; each level is stably parted by its bit, zeros first."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(top).bit_length())
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b & 1).astype(np.uint8)
            self.levels.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each ``symbol`` in front of position ``i``."""
        low, high = np.zeros_like(i), i
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            a, b = level.rank(low), level.rank(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros):
            one, r = level.get(i), level.rank(i)
            out = out << 1 | one
            i = np.where(one, zeros + r, i - r)
        return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling over the whole ``text``, whose last symbol occurs nowhere else."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step, n = 1, len(text)
    while True:
        then = np.full(n, -1, np.int64)
        then[:-step or None] = rank[step:] if step < n else -1
        key = rank * (n + 1) + then + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search and located occurrences over symbols >= 1; the end mark 0 is added here."""

    def __init__(self, text: np.ndarray):
        text = np.append(text.astype(np.int64), 0)
        order = suffix_order(text)
        self.top = int(text.max())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.top + 2))))
        self.bwt = WaveletMatrix(text[order - 1], self.top)
        marked = order % SAMPLE == 0
        self.marked, self.samples, self.size = BitVector(marked), order[marked], len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the suffixes that start with each phrase (all of one length)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.flatnonzero((phrases <= self.top).all(axis=1))
        high[(phrases > self.top).any(axis=1)] = 0
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            low[live] = self.first[c] + self.bwt.rank(c, low[live])
            high[live] = self.first[c] + self.bwt.rank(c, high[live])
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step backwards through the text to a sampled position."""
        at, out, steps = rows.copy(), np.full(len(rows), -1, np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            hit = self.marked.get(at[open_])
            done = open_[hit]
            out[done] = self.samples[self.marked.rank(at[done])] + steps
            open_ = open_[~hit]
            c = self.bwt.access(at[open_])
            at[open_] = self.first[c] + self.bwt.rank(c, at[open_])
            steps += 1
        return out


class Phrases:
    """The windows of a block of items as symbols (2 and up), by length, and the items that hold each."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = WINDOW_WORDS):
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            w = H.words(text, H.NOT_WORD)[0].tolist()
            n = min(size, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                found.setdefault(tuple(w[i : i + n]), set()).add(name)
        self.vocabulary = np.array(sorted({x for p in found for x in p}), np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.vocabulary & np.uint64(self.maybe.size - 1)] = True
        self.lengths = sorted({len(p) for p in found})
        self.windows, self.items, self.allowed = {}, {}, {}
        for n in self.lengths:
            keys = sorted(p for p in found if len(p) == n)
            self.windows[n] = np.searchsorted(self.vocabulary, np.array(keys, np.uint64)) + 2
            self.items[n] = [found[p] for p in keys]
            self.allowed[n] = np.zeros(len(self.vocabulary) + 2, bool)
            self.allowed[n][self.windows[n]] = True

    def symbols(self, word_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, index) of the stretches of words that could hold a phrase, each followed by a break (1, -1)."""
        if not self.lengths:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, end = H.runs(self.maybe[(word_hashes & np.uint64(self.maybe.size - 1)).astype(np.int64)])
        out, at = [], []
        long_enough = end - start >= self.lengths[0]
        for a, b in zip(start[long_enough], end[long_enough]):
            part = word_hashes[a:b]
            k = np.minimum(np.searchsorted(self.vocabulary, part), len(self.vocabulary) - 1)
            sym = np.where(self.vocabulary[k] == part, k + 2, 1)
            keep = np.zeros(len(sym), bool)
            for n in self.lengths:
                s, e = H.runs(self.allowed[n][sym])
                for x, y in zip(s[e - s >= n], e[e - s >= n]):
                    keep[x:y] = True
            for x, y in zip(*H.runs(keep)):
                out += [sym[x:y], [1]]
                at += [np.arange(a + x, a + y), [-1]]
        return (np.concatenate(out), np.concatenate(at)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def find(shard: list[tuple[np.ndarray, np.ndarray, np.ndarray]], phrases: Phrases) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """Merged word spans and items of each document of a shard of (documents, symbols, word indexes)."""
    doc, word = np.concatenate([x[0] for x in shard]), np.concatenate([x[2] for x in shard])
    index = FMIndex(np.concatenate([x[1] for x in shard]))
    cover = np.zeros(len(doc) + 1, np.int64)
    named: dict[int, set[str]] = {}
    for n in phrases.lengths:
        low, high = index.search(phrases.windows[n])
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        place = index.locate(rows)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + n, -1)
        for d, w in np.unique(np.stack((doc[place], window), 1), axis=0):
            named.setdefault(int(d), set()).update(phrases.items[n][w])
    spans: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(*H.runs(np.cumsum(cover[:-1]) > 0)):
        spans.setdefault(int(doc[a]), []).append((int(word[a]), int(word[b - 1]) + 1))
    return {d: (spans[d], named[d]) for d in spans}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    for x in column:
        buffer = x.as_buffer()
        yield b"" if buffer is None else buffer.to_pybytes()


def _search(phrases, names: tuple[str, str, str]):
    n_name, hits_name, items_name = names

    def run(batches):
        held = Phrases.__new__(Phrases)  # broadcast as plain values: the package is not installed on executors
        held.__dict__.update(phrases.value)
        for batch in batches:
            n_words, found, shard, size = np.zeros(batch.num_rows, np.int64), {}, [], 0
            for numbers, buffer, starts in H.chunks(text_bytes(batch.column("text"))):
                words, start, _ = H.words(buffer, H.NOT_WORD)
                owner = H.owners(starts, start)
                count = np.bincount(owner, minlength=len(numbers))
                n_words[numbers] = count
                first = np.cumsum(count) - count  # index of each document's first word
                # a break between documents: no phrase crosses it
                sym, at = held.symbols(np.insert(words, first, 0))
                if len(sym):
                    place = np.maximum(at, 0)
                    d = np.searchsorted(first + np.arange(len(first)), place, side="right") - 1
                    shard.append((np.where(at < 0, -1, numbers[d]), sym, place - first[d] - d - 1))
                    size += len(sym)
                if size >= SHARD_SYMBOLS:
                    found |= find(shard, held)
                    shard, size = [], 0
            if shard:
                found |= find(shard, held)
            hits, items = batch.column(hits_name).to_pylist(), batch.column(items_name).to_pylist()
            for d, (spans, ids) in found.items():
                before = [(x["start"], x["stop"]) for x in hits[d]]
                hits[d] = [{"start": a, "stop": b} for a, b in merged(before + spans)]
                items[d] = sorted(ids.union(items[d]))
            new = {n_name: pa.array(n_words, pa.int64()), hits_name: pa.array(hits, batch.schema.field(hits_name).type), items_name: pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(k)) for k, c in enumerate(batch.schema.names)], names=batch.schema.names)

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES, then=None) -> DataFrame:
    """Documents with n_words, hits (merged word spans that test phrases cover) and items (ids, sorted as strings).

    ``then`` takes the name of the hits and gives a function of record batches that runs in the same task as the last search.
    """
    context = docs.sparkSession.sparkContext
    names = fresh("words"), fresh("hits"), fresh("items")
    out = docs.select("*", F.lit(0).cast("bigint").alias(names[0]), F.array().cast(SPANS).alias(names[1]), F.array().cast("array<string>").alias(names[2]))
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))).toLocalIterator()
    items = ((r[0], r[1].encode()) for r in rows)
    blocks = batches_of(items, block_bytes, lambda x: len(x[1])) if not benchmark.isEmpty() else iter([[]])
    block = next(blocks)
    while block is not None:
        search, block = _search(context.broadcast(vars(Phrases(block, window))), names), next(blocks, None)
        last = then(names[1]) if then and block is None else None
        out = out.mapInArrow(lambda batches, search=search, last=last: last(search(batches)) if last else search(batches), out.schema)
    added = dict(zip(("n_words", "hits", "items"), names))
    return out.select(*[c for c in docs.columns if c not in added], *[F.col(v).alias(k) for k, v in added.items()])


def leak_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, the hash of its item ids, and whether it is contaminated."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    found = find_leaks(docs.select("doc_id", "text"), benchmark).withColumn("n_hit", n_hit)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), sha256_hex(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _cut(hits_name: str):
    def run(batches):
        for batch in batches:
            k = batch.schema.names.index("text")
            texts = []
            for text, hits in zip(batch.column("text").to_pylist(), batch.column(hits_name).to_pylist()):
                if text is not None and hits:
                    raw = text.encode()
                    _, start, end = H.words(raw, H.NOT_WORD)
                    kept, at = [], 0
                    for x in hits:
                        kept.append(raw[at : start[x["start"]]])
                        at = end[x["stop"] - 1]
                    text = (b"".join(kept) + raw[at:]).decode()
                texts.append(text)
            columns = [pa.array(texts, batch.schema.field(k).type) if i == k else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with the words of every hit span cut out and n_chars brought up to date, in the columns of ``docs``.

    A document of which only marks and white space are left goes; documents without a hit stay as they are.
    """
    hits = fresh("hits")
    found = find_leaks(docs.withColumnsRenamed({c: fresh(c) for c in docs.columns if c in ("n_words", "hits", "items")}), benchmark, then=_cut)
    found = found.withColumnRenamed("hits", hits).drop("n_words", "items")
    cut = found.toDF(*docs.columns, hits).where((F.size(hits) == 0) | F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    n_chars = F.when(F.size(hits) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return cut.select(*[n_chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (SELECT DISTINCT item, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS p
            FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrases),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
           FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item, i, n FROM places JOIN phrases USING (n, p)),
covered AS (SELECT doc_id, count(*)::BIGINT AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
