"""Toxicity by a linear-chain conditional random field over tokens.

Labelled tokens. Documents are labelled, tokens are not. In a bounded sample of labelled documents every word is counted once
a document, apart for toxic and other ones, with a sketch of the contexts it stands in. A word that toxic documents hold
far more often (a likelihood-ratio test, and several contexts, since a copied text says little) is a toxic token where it
stands in a toxic document; every other token is not. Sentences with such words, from documents of either label, and a
hashed share of the other sentences are the training sequences.

The field has two states. A token's score is the sum of hashed feature weights (the word, its neighbours, its first and
last three bytes, its form); pairs of states have weights of their own. Weights are fitted by steps of full gradient: each step
is one Spark pass over the training sequences, whose tasks return one gradient each.

Scores. Forward-backward gives each token its marginal probability. They are aggregated per document (the chance of no toxic
token, the largest marginal, the length) and mapped to a score by a logistic function fitted on the sample. Runs of tokens at
one half or more are the offending spans, in code points. A sequence is a sentence, cut after 64 tokens; features look across.

Bounds, all parameters: ``most_labels`` labelled documents in hash order, one text each; buckets of the hashed features.
Every document is scored whole, in pieces of a MiB. Rows whose crc32(doc_id) leaves 0 modulo 5 are held out: their labels are not read.

Defined cases: a null text is empty, an empty one gets the score of a text without tokens; a null doc_id is never held out and
never learned from; repeated rows get equal scores; without labels of both kinds every score is the share of toxic ones
(0 without any); an empty table gives no rows. Added columns replace input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import hashing as H
from corpusloom.llm.common import materialise
from corpusloom.llm.decontamination import text_bytes

MOST_LABELS = 20_000
FOLDS = 5
BUCKETS = 1 << 16
LONGEST = 64  # tokens of a sequence
STEPS, RATE, PULL = 14, 1.0, 1e-3
LEAST_TEST, LEAST_CONTEXTS, LEAST_RATIO = 20.0, 5, 3.0
OTHER_SHARE = 16  # one in so many sentences without a toxic word is learned from
PIECE = 1 << 20
SEED = "toxic-1"
SENTENCE = np.zeros(256, bool)
SENTENCE[[0x0A, 0x0D, 0x21, 0x2E, 0x3F]] = True
N_FEATURES = 6
N_STATES = 4  # free state weights: start toxic, other -> toxic, toxic -> other, toxic -> toxic


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def pieces(texts, most: int = PIECE):
    """(number of the text, bytes, offset) with long texts cut at white space (anywhere, if a piece has none)."""
    for k, text in enumerate(texts):
        at = 0
        while len(text) - at > most:
            cut = max(text.rfind(b" ", at, at + most), text.rfind(b"\n", at, at + most))
            if cut <= at:
                cut = at + most
                while cut > at + 1 and text[cut] & 0xC0 == 0x80:
                    cut -= 1
            yield k, text[at:cut], at
            at = cut
        yield k, text[at:], at


def buffers(texts):
    """(tokens, buffer, starts, pieces in it, text number of each token) for about a MiB of text at a time."""
    cut = list(pieces(texts))
    for numbers, buffer, starts in H.chunks([p for _, p, _ in cut]):
        t = Tokens(buffer, starts)
        if t.n:
            mine = [cut[k] for k in numbers]
            yield t, buffer, starts, mine, np.array([c[0] for c in mine])[t.owner]


class Tokens:
    """The tokens of a buffer of texts: word hashes, hashed features, owner, byte span and the sequences they form."""

    def __init__(self, buffer: bytes, starts: np.ndarray):
        raw = np.frombuffer(buffer, np.uint8)
        data = H.LOWER_BYTES[raw]
        self.start, self.end = H.runs(~H.NOT_WORD[data])
        self.n = n = len(self.start)
        self.owner = H.owners(starts, self.start)
        if not n:
            self.sequence = np.zeros(0, np.int64)
            return
        sums = H.prefix_hash(data)
        self.word = H.span_hash(sums, self.start, self.end)
        marks = np.concatenate(([0], np.cumsum(SENTENCE[raw])))
        gap = np.ones(n, bool)
        gap[1:] = (marks[self.start[1:]] > marks[self.end[:-1]]) | (self.owner[1:] != self.owner[:-1])
        first = np.flatnonzero(gap)
        place = np.arange(n) - first[np.cumsum(gap) - 1]
        self.sequence = np.flatnonzero(gap | (place % LONGEST == 0))
        sides = np.concatenate((self.word[:1], self.word, self.word[-1:]))
        inside = np.concatenate(([False], self.owner[1:] == self.owner[:-1], [False]))
        self.before = np.where(inside[:-1], sides[:-2], np.uint64(1))
        self.after = np.where(inside[1:], sides[2:], np.uint64(2))
        width = np.minimum(self.end - self.start, 3)
        capital = (raw[self.start] >= 0x41) & (raw[self.start] <= 0x5A)
        self.form = capital * 64 + gap * 32 + np.minimum(self.end - self.start, 20)
        self.head, self.tail = H.span_hash(sums, self.start, self.start + width), H.span_hash(sums, self.end - width, self.end)

    def features(self) -> np.ndarray:
        """(tokens, N_FEATURES) buckets."""
        kinds = (self.word, self.before, self.after, self.head, self.tail, self.form.astype(np.uint64))
        with np.errstate(over="ignore"):
            return np.stack([(H.mix(x * np.uint64(2 * N_FEATURES + 1) + np.uint64(k)) & np.uint64(BUCKETS - 1)).astype(np.int32) for k, x in enumerate(kinds)], 1)


def chain(x: np.ndarray, sequence: np.ndarray, states: np.ndarray, pairs: bool = False):
    """Marginals of the toxic state, and with ``pairs`` the expected (start toxic, other->toxic, toxic->other, toxic->toxic).

    x: e**score of each token; sequence: first token of each sequence. Forward and backward values are kept as toxic / other
    ratios; all sequences advance together, the longest first.
    """
    n = len(x)
    s, t01, t10, t11 = np.exp(states)
    end = np.append(sequence[1:], n)
    length = end - sequence
    order = np.argsort(-length, kind="stable")
    first, last, size = sequence[order], end[order] - 1, length[order]
    alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    r, q = np.empty(n), np.ones(n)
    for t, k in enumerate(alive):
        at = first[:k] + t
        if t == 0:
            r[at] = s * x[at]
        else:
            old = r[at - 1]
            r[at] = x[at] * (t01 + t11 * old) / (1 + t10 * old)
        if t:
            at = last[:k] - t
            y = x[at + 1] * q[at + 1]
            q[at] = (t10 + t11 * y) / (1 + t01 * y)
    p = r * q / (1 + r * q)
    if not pairs:
        return p, None
    inner = np.ones(n, bool)
    inner[end - 1] = False
    a = np.flatnonzero(inner)
    y = x[a + 1] * q[a + 1]
    w01, w10, w11 = t01 * y, t10 * r[a], t11 * r[a] * y
    total = 1 + w01 + w10 + w11
    return p, np.array([p[sequence].sum(), (w01 / total).sum(), (w10 / total).sum(), (w11 / total).sum()])


def scores(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(weights[features].sum(1), -30, 30))


def sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """(doc_id, text, toxic): at most ``most`` labelled documents that are not held out, one text each."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")  # at most ``most`` small rows
    return materialise(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-sample")


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, other, contexts): documents of either label that hold a word and a sketch of its toxic contexts."""

    def merge(parts):
        word = np.concatenate([p[0] for p in parts])
        order = np.argsort(word, kind="stable")
        first = np.flatnonzero(np.append(True, word[order][1:] != word[order][:-1]))
        return word[order][first], *(f.reduceat(np.concatenate([p[k] for p in parts])[order], first) for k, f in ((1, np.add), (2, np.add), (3, np.bitwise_or)))

    def run(batches):
        for batch in batches:
            toxic, parts = batch.column("toxic").to_numpy(), []
            for t, _, _, _, owner in buffers(text_bytes(batch.column("text"))):
                with np.errstate(over="ignore"):
                    bit = np.uint64(1) << (H.mix(t.before * np.uint64(5) ^ H.mix(t.after)) & np.uint64(63))
                order = np.lexsort((owner, t.word))
                word, owner, bit = t.word[order], owner[order], bit[order]
                new = np.append(True, (word[1:] != word[:-1]) | (owner[1:] != owner[:-1]))
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                mine = toxic[owner] == 1
                sums = [np.add.reduceat((new & c).astype(np.int64), first) for c in (mine, ~mine)]
                parts.append((word[first], *sums, np.bitwise_or.reduceat(np.where(mine, bit, np.uint64(0)), first)))
            if parts:
                out = merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in out], names=["word", "toxic", "other", "contexts"])

    counts = rows.select("text", "toxic").mapInArrow(run, "word bigint, toxic bigint, other bigint, contexts bigint")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("contexts").alias("contexts"))


def toxic_words(rows: DataFrame, n_toxic: int, n_other: int) -> np.ndarray:
    """Hashes of the words that toxic documents of the sample hold far more often, in several contexts."""
    a, c = F.col("toxic").cast("double"), F.col("other").cast("double")
    share = (a + c) / (n_toxic + n_other)
    term = lambda seen, of: F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0)
    test = 2 * (term(a, n_toxic) + term(c, n_other))
    ratio = (a + 0.5) / n_toxic / ((c + 0.5) / n_other)
    few = word_counts(rows).where((test >= LEAST_TEST) & (ratio >= LEAST_RATIO) & (F.bit_count("contexts") >= LEAST_CONTEXTS))
    return np.sort(np.array([r[0] for r in few.select("word").collect()], np.int64).view(np.uint64))  # bounded by the sample


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def sequences(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """(features, states): the training sequences as flat lists."""

    def run(batches):
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for t, _, _, _, owner in buffers(text_bytes(batch.column("text"))):
                hit = among(t.word, words)
                end = np.append(t.sequence[1:], t.n)
                with np.errstate(over="ignore"):
                    draw = H.mix(np.bitwise_xor.reduceat(H.mix(t.word), t.sequence)) % np.uint64(OTHER_SHARE) == 0
                keep = np.flatnonzero(np.logical_or.reduceat(hit, t.sequence) | draw)
                size = (end - t.sequence)[keep]
                at = np.repeat(t.sequence[keep] - np.cumsum(size) + size, size) + np.arange(size.sum())
                state = (hit & (toxic[owner] == 1))[at].astype(np.int8)
                offsets = np.concatenate(([0], np.cumsum(size)))
                lists = [pa.ListArray.from_arrays(pa.array(offsets * k, pa.int32()), pa.array(v)) for k, v in ((N_FEATURES, t.features()[at].ravel()), (1, state))]
                yield pa.RecordBatch.from_arrays(lists, names=["features", "states"])

    return materialise(rows.select("text", "toxic").mapInArrow(run, "features array<int>, states array<tinyint>").repartition(8), "toxic-sequences")


def gradients(table: DataFrame, weights: np.ndarray, states: np.ndarray) -> np.ndarray:
    """The gradient of the log likelihood, weights first; each task returns its sum as one row."""

    def run(batches):
        out, seen = np.zeros(BUCKETS + N_STATES), False
        for batch in batches:
            lists = batch.column("states")
            if not len(lists):
                continue
            seen = True
            y = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            f = batch.column("features").flatten().to_numpy().reshape(len(y), N_FEATURES)
            first = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
            p, expected = chain(scores(f, weights), first, states, pairs=True)
            out[:BUCKETS] += np.bincount(f.ravel(), np.repeat(y - p, N_FEATURES), BUCKETS)
            inner = np.ones(len(y), bool)
            inner[first] = False
            old, new = np.append(0, y[:-1])[inner], y[inner]
            out[BUCKETS:] += np.array([y[first].sum(), ((1 - old) * new).sum(), (old * (1 - new)).sum(), (old * new).sum()]) - expected
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1)), pa.array([out])], names=["k", "g"])

    parts = table.mapInArrow(run, "k bigint, g array<double>").collect()  # one row a task, 8 tasks at most
    return sum((np.array(r["g"]) for r in parts), np.zeros(BUCKETS + N_STATES))


def fit_chain(table: DataFrame, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, state weights) after ``steps`` steps of the gradient, scaled per weight by its past."""
    w = np.zeros(BUCKETS + N_STATES)
    w[BUCKETS:] = [-2.0, -2.0, 0.0, 0.0]
    past = np.zeros_like(w)
    for _ in range(steps):
        g = np.round(gradients(table, w[:BUCKETS], w[BUCKETS:]), 9) - PULL * w
        past += g * g
        w = w + RATE * g / np.sqrt(past + 1e-6) * (np.abs(g) > 1e-9)
    return w[:BUCKETS], w[BUCKETS:]


def evidence(texts: list, weights: np.ndarray, states: np.ndarray, spans: bool = True):
    """Per text the three aggregates of its marginals, and its offending spans (owner, start, end, largest marginal)."""
    quiet, largest, count = np.zeros(len(texts)), np.full(len(texts), 1e-6), np.zeros(len(texts))
    found, done = [], {}
    for t, buffer, starts, mine, owner in buffers(texts):
        p, _ = chain(scores(t.features(), weights), t.sequence, states)
        p = np.minimum(p, 1 - 1e-9)
        quiet += np.bincount(owner, -np.log1p(-p), len(texts))
        np.maximum.at(largest, owner, p)
        count += np.bincount(owner, minlength=len(texts))
        hit = np.flatnonzero(p >= 0.5)
        if spans and len(hit):
            raw = np.frombuffer(buffer, np.uint8)
            points = np.concatenate(([0], np.cumsum(raw & 0xC0 != 0x80)))
            part = t.owner[hit]
            new = np.append(True, (np.diff(hit) != 1) | np.isin(hit[1:], t.sequence) | (np.diff(part) != 0))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(hit)) - 1
            for a, b in zip(first, last):
                number, _, offset = mine[part[a]]
                base = done.setdefault((number, offset), len(texts[number][:offset].decode("utf-8", "replace")) if offset else 0) - points[starts[part[a]]]
                found.append((number, int(points[t.start[hit[a]]] + base), int(points[t.end[hit[b]]] + base), float(p[hit[a] : hit[b] + 1].max())))
    return np.stack([np.ones(len(texts)), np.log(quiet + 1e-6), np.log(largest) - np.log1p(-largest), np.log1p(count)], 1), found


def fit_scores(rows: DataFrame, weights: np.ndarray, states: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic weights of the aggregates, by Newton steps on the sample's aggregates (at most ``most_labels`` rows of four)."""

    def run(batches):
        for batch in batches:
            x, _ = evidence(list(text_bytes(batch.column("text"))), weights, states, spans=False)
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), batch.column("toxic")], names=["a", "b", "c", "d", "toxic"])

    held = rows.select("text", "toxic").mapInArrow(run, "a double, b double, c double, d double, toxic int").toPandas().sort_values(["b", "c", "d", "toxic"])
    x, y = held[["a", "b", "c", "d"]].to_numpy(), held["toxic"].to_numpy(float)
    v = np.zeros(4)
    pull = np.diag([1e-3, 1e-2, 1e-2, 1e-2])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        v = v + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (y - p) - pull @ v)
    return v


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS, steps: int = STEPS):
    """(feature weights, state weights, logistic weights); None with the share of toxic rows where only one kind is known."""
    rows = sample(docs, labels, most_labels)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return None, float(bool(n.get(1, 0)))
    words = toxic_words(rows, n[1], n[0])
    weights, states = fit_chain(sequences(rows, words), steps)
    return (weights, states, fit_scores(rows, weights, states)), None


def score_documents(docs: DataFrame, model, constant: float | None) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans (start, end, probability) of every document."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            score, found = np.full(n, constant or 0.0), []
            if model is not None:
                weights, states, logistic = model
                x, found = evidence(list(text_bytes(batch.column("text"))), weights, states)
                score = np.round(1 / (1 + np.exp(-np.clip(x @ logistic, -30, 30))), 6)
            lists = [[] for _ in range(n)]
            for number, start, end, p in found:
                lists[number].append({"start": start, "end": end, "probability": round(p, 6)})
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(lists, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "spans"])

    schema = "doc_id bigint, held_out boolean, score double, predicted int, spans array<struct<start:bigint,end:bigint,probability:double>>"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, schema)


def toxic_digest(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The scores with the offending spans as start:end, comma-joined."""
    scored = score_documents(docs, *fit(docs, labels, **params))
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scored.withColumn("n_spans", F.size("spans").cast("bigint")).withColumn("spans", text)
