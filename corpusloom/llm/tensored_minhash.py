"""MinHash near-duplicates with tensored banding.

A document is the set of hashes of its word shingles. Instead of one group of minhashes for each table, a small number of
collections (16 of 3 minhashes) is computed, and every pair of collections is the key of a table: 120 tables of 6 minhashes
for the price of 48. At similarity 0.8 a pair is missed by all tables with probability 0.0002.

Equal sets are one class; only a class's smallest id goes on. In each bucket every member is paired with the smallest id
(no pairs within the bucket), the pairs are confirmed on the full sets, and linked documents are joined to components.
Buckets that still hold several components are not paired out either: a crowd of variants of one text, each below the
threshold to the others, would give the square of its size. Their documents go through an exact prefix join instead. All
sets are ordered alike, rare shingles first; two sets that are similar enough share a shingle near both fronts, with enough
left behind it, so only such pairs are confirmed. So each pair that shares a bucket is confirmed, refuted by its prefixes
or already in one component, and nothing is capped. Sets are built only for documents of candidate pairs and such buckets.

Keys are counted before members are joined to them, and both sides of that join are plain scans, so a key that holds a
third of all documents is split like any skewed join.

Defined cases: a text without words, or null, has an empty set and links with nothing; a document without id cannot be
named and links with nothing (component null, kept); repeated rows of one document are in one class and kept or dropped
together; an empty table gives no rows. Added columns replace input columns of the same name; other columns are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import hashing as H
from corpusloom.llm.common import connected_components, fresh, materialise
from corpusloom.llm.decontamination import text_bytes

COLLECTIONS, ROWS = 16, 3
ORDER_BITS = 18  # shingle frequencies are counted in 2**18 classes: any order is exact, a good one is quick
SKETCH_WORDS = 8  # of 64 parities
PERCENT = 80
SHINGLE_WORDS = 5


def word_lists(texts):
    """(text number, word hashes) of texts (bytes), in order; words are cut at ASCII white space, A-Z lower-cased."""
    for numbers, buffer, starts in H.chunks(texts):
        words, start, _ = H.words(buffer, H.SPACES)
        first = np.searchsorted(start, starts)
        for k, part in enumerate(np.split(words, first[1:])):
            yield int(numbers[k]), part


def minhashes(sets: list[np.ndarray], collections: int = COLLECTIONS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit value for each non-empty set and collection: ``rows`` minhashes mixed."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.zeros((len(sets), collections), np.uint64)
    salts = H.mix(np.arange(1, 2 * collections * rows + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        for c in range(collections):
            for r in range(rows):
                a, b = salts[2 * (c * rows + r)] | np.uint64(1), salts[2 * (c * rows + r) + 1]
                h = (flat ^ b) * a
                h ^= h >> np.uint64(29)
                h *= a
                out[:, c] = H.mix(out[:, c] * np.uint64(31) + np.minimum.reduceat(h, first))
    return out


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, parts): the set's size, a 128-bit key of the set (null if empty), the collections."""

    def run(batches):
        for batch in batches:
            sets = [H.shingles(w, shingle) for _, w in word_lists(text_bytes(batch.column("text")))]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            parts = [None] * len(sets)
            full = [k for k, s in enumerate(sets) if len(s)]
            at = 0
            while at < len(full):  # about 2**20 shingles at a time
                size, end = 0, at
                while end < len(full) and (end == at or size + len(sets[full[end]]) <= 1 << 20):
                    size += len(sets[full[end]])
                    end += 1
                for k, row in zip(full[at:end], minhashes([sets[k] for k in full[at:end]]).view(np.int64)):
                    parts[k] = row
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(parts, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "parts"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, parts array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, members): the sorted shingle hashes, as bytes, of the documents named in ``ids`` (one row each)."""

    def run(batches):
        for batch in batches:
            sets = [H.shingles(w, shingle).tobytes() for _, w in word_lists(text_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["id", "members"])

    wanted = docs.select("doc_id", "text").join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    return wanted.mapInArrow(run, "id bigint, members binary").dropDuplicates(["id"])


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold shingles of each class (hash modulo 2**ORDER_BITS): a table of fixed size."""

    def run(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for s in batch.column("members"):
                total += np.bincount((np.frombuffer(s.as_buffer(), np.uint64) & np.uint64((1 << ORDER_BITS) - 1)).astype(np.int64), minlength=1 << ORDER_BITS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["class", "n"])

    found = sets.select("members").mapInArrow(run, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << ORDER_BITS, np.int64)
    counts[found.column("class").to_numpy()] = found.column("n").to_numpy()
    return counts


def prefix_pairs(sets: DataFrame, of: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that can be similar enough, by an exact prefix join.

    ``sets`` has (id, members), ``of`` has (id, component). Shingles are ordered by (count of their class, hash). If two
    sets are similar enough, their first common shingle has enough shingles from its place on in both sets; the larger
    set's lies in its first (1 - t) part, the smaller set's in its first 1 - 2t / (1 + t) part.

    A set also carries the parities of its shingles in 512 classes. Two sketches differ in no more bits than the sets differ in
    shingles, so a pair whose sketches differ in more than similar sets can is not formed: sets of one crowd that
    only share a common stock stay apart.
    """
    counts = shingle_counts(sets)

    def run(batches):
        for batch in batches:
            ids, tokens, places, sizes, odd = [], [], [], [], []
            for k, s in enumerate(batch.column("members")):
                x = np.frombuffer(s.as_buffer(), np.uint64)
                n = len(x)
                length = n - -(-percent * n // 100) + 1
                front = np.lexsort((x, counts[(x & np.uint64((1 << ORDER_BITS) - 1)).astype(np.int64)]))[:length]
                ids.append(np.full(len(front), k))
                tokens.append(x[front].view(np.int64))
                places.append(np.arange(len(front)))
                sizes.append(np.full(len(front), n))
                parity = np.bincount((x >> np.uint64(55)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
                odd.append(np.repeat(np.packbits(parity.astype(np.uint8)).view(np.int64)[None], len(front), 0))
            if ids:
                at = np.concatenate(ids)
                columns = [batch.column("id").take(pa.array(at)), batch.column("component").take(pa.array(at))]
                columns += [pa.array(np.concatenate(c)) for c in (tokens, places, sizes)]
                columns += [pa.array(np.ascontiguousarray(c)) for c in np.concatenate(odd).T]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "token", "place", "n", *words])

    words = [f"odd{k}" for k in range(SKETCH_WORDS)]
    kinds = "id bigint, component bigint, token bigint, place bigint, n bigint, " + ", ".join(f"{w} bigint" for w in words)
    fronts = sets.join(of, "id").select("id", "component", "members").mapInArrow(run, kinds)
    fronts = materialise(fronts, "minhash-fronts")
    short = fronts.where(F.expr(f"(n - place) * {100 + percent} >= {2 * percent} * n")).alias("x")
    differ = " + ".join(f"bit_count(x.{w} ^ y.{w})" for w in words)
    apart = F.expr(f"({differ}) * {100 + percent} <= {100 - percent} * (x.n + y.n)")
    both = short.join(fronts.alias("y"), F.expr("x.token = y.token AND struct(x.n, x.id) < struct(y.n, y.id) AND x.component <> y.component") & F.expr(f"100 * x.n >= {percent} * y.n AND least(x.n - x.place, y.n - y.place) * {100 + percent} >= {percent} * (x.n + y.n)") & apart)
    return both.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def sets_of(pairs: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """The full sets of the documents named in ``pairs`` (a, b), written."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    return materialise(full_sets(docs, materialise(ids, "minhash-ids"), shingle), "minhash-sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(x) + len(y)
                joined = np.sort(np.concatenate((x, y)), kind="stable")
                common = int((joined[1:] == joined[:-1]).sum())
                keep.append(100 * common >= percent * (both - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda id_, name: sets.select(F.col("id").alias(id_), F.col("members").alias(name))
    return pairs.join(side("b", "y"), "b").join(side("a", "x"), "a").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked id, itself included) and kept."""
    signed = materialise(signatures(docs, shingle), "minhash-signatures")
    named = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = materialise(named.groupBy("set_key").agg(F.min("doc_id").alias("id")), "minhash-classes")
    members = named.join(classes.select("id", F.col("set_key").alias("key")), (F.col("doc_id") == F.col("id")) & (F.col("set_key") == F.col("key")))
    members = members.select("id", F.col("n_shingles").alias("n"), "parts").dropDuplicates(["id"])
    tables = [F.xxhash64(F.lit(i * COLLECTIONS + j), F.col("parts")[i], F.col("parts")[j]) for i in range(COLLECTIONS) for j in range(i + 1, COLLECTIONS)]
    members = materialise(members, "minhash-members")
    keyed = members.select("id", "n", F.explode(F.array(*tables)).alias("k"))
    buckets = keyed.groupBy("k").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = materialise(buckets, "minhash-buckets")
    # members of buckets of more than two; a bucket of two is its own pair
    crowded = materialise(keyed.join(buckets.where("size > 2").select("k", "low"), "k"), "minhash-crowded")
    stars = buckets.where("size = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).union(crowded.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")))
    sizes = members.select(F.col("id").alias("s"), "n")
    fits = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")

    def sized(pairs):
        both = pairs.join(sizes.select(F.col("s").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("s").alias("b"), F.col("n").alias("nb")), "b")
        return both.where(fits).select("a", "b")

    pairs = materialise(sized(stars.distinct()), "minhash-pairs")
    links = materialise(confirm(pairs, sets_of(pairs, docs, shingle), percent), "minhash-links")
    parts = materialise(connected_components(links, "minhash-components"), "minhash-parts")
    # documents of crowded buckets that hold more than one component are compared across components by their prefixes
    placed = crowded.join(parts.withColumnRenamed("node", "id"), "id", "left").select("k", "id", F.coalesce("component", "id").alias("component"))
    placed = materialise(placed, "minhash-placed")
    mixed = placed.groupBy("k").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("k")
    rest = placed.join(materialise(mixed, "minhash-mixed"), "k").groupBy("id").agg(F.min("component").alias("component"))
    rest = materialise(rest, "minhash-rest")
    sets = materialise(full_sets(docs, rest.select("id"), shingle), "minhash-sets")
    more = confirm(materialise(prefix_pairs(sets, rest, percent), "minhash-pairs"), sets, percent)
    parts = materialise(connected_components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "minhash-components"), "minhash-parts")
    # classes to components, then rows to classes; both joins are between written tables
    of_class = classes.join(parts.withColumnRenamed("node", "id"), "id", "left").select(F.col("set_key").alias("key"), F.coalesce("component", "id").alias("found"))
    of_class = materialise(of_class, "minhash-of-class")
    out = signed.join(of_class, F.col("set_key") == F.col("key"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Documents of which no near-duplicate with a smaller id exists: one of each group, in the columns of ``docs``."""
    gone = near_duplicates(docs, shingle, percent).where("NOT kept").select(F.col("doc_id").alias(name := fresh("id"))).distinct()
    gone = materialise(gone, "minhash-gone")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
