"""Audit of five document filters: what each removes, alone and in every order, from one additive table of mask counts.

Four filters look at a text alone: A under 200 words, B under half of the words distinct, C over 3 % capitals, D one of
``#$%&*|``. Filter E fails a row whose text also stands under a smaller doc_id. It is found with a counting-Bloom prepass:
every row adds one to two counters named by its text's hash, the tasks' counters are summed, and a text with a counter of
one is unique for certain. Only the other texts, possible repeats, are shuffled, whole and merged in each task first; the
smallest id of each full text is exact. A row is a possible repeat by its counters and the first of its text by (id, two
text hashes); a possible repeat that is not the first fails E.

The flags become one mask a row, and rows become counts by (part, mask). All 120 orders are sums over these counts: what a
filter removes after the set S of earlier filters are the masks that hold it and none of S. So orders never touch rows.

The counters are ``bits_per_row`` a row, at most ``most_bits``; their broadcast holds the words of 64 counters that have
one above 1, at most most_bits / 64 rows. With more rows than that bound serves, more unique texts are shuffled, and the
result is the same.

Defined cases: a null text is empty, a null lang is the part ''; a row without doc_id never fails E and is no reason for
others to fail; rows that repeat id and text are both the first; labels are the largest of an id's rows, without labels or
with null ones a row counts as neither good nor toxic; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE, materialise

FILTERS = "ABCDE"
LEAST_WORDS, MOST_CAPITALS, LEAST_DISTINCT = 200, 3, 50
MARKS = "[#$%&*|]"
BITS_PER_ROW, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27


def text_mask(text):
    """Bits 0 to 3: the failures of A to D."""
    words = F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failures = (n < LEAST_WORDS, 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * F.length(text), text.rlike(MARKS))
    mask = F.lit(0)
    for k, failed in enumerate(failures):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    return mask


def counters(h, bits: int):
    """The two counters of a text hash."""
    return [F.pmod(x, F.lit(bits)) for x in (h, F.xxhash64(h))]


def repeated_words(hashes: DataFrame, bits: int) -> DataFrame:
    """(word, held): the words of 64 counters with the bits of those counters that reached two."""
    counts = hashes.select(F.explode(F.array(*counters(F.col("h"), bits))).alias("counter")).groupBy("counter").agg(F.count(F.lit(1)).alias("n"))
    word = F.shiftright("counter", 6).alias("word")
    return counts.where("n > 1").groupBy(word).agg(F.expr("bit_or(shiftleft(1L, CAST(counter & 63 AS INT)))").alias("held"))


def possible_repeats(rows: DataFrame, words: DataFrame, bits: int, how: str) -> DataFrame:
    """Rows (with their hash h) whose counters all reached two; with how = 'left' all rows, told apart by ``possible``."""
    hit = F.lit(True)
    for k, counter in enumerate(counters(F.col("h"), bits)):
        side = F.broadcast(words.select(F.col("word").alias(f"word{k}"), F.col("held").alias(f"held{k}")))  # at most bits / 64 rows
        rows = rows.withColumn(f"counter{k}", counter).withColumn(f"word{k}", F.shiftright(f"counter{k}", 6)).join(side, f"word{k}", how)
        hit = hit & F.coalesce(F.expr(f"(held{k} & shiftleft(1L, CAST(counter{k} & 63 AS INT))) <> 0"), F.lit(False))
    rows = rows.withColumn("possible", hit)
    extra = [f"{c}{k}" for c in ("counter", "word", "held") for k in (0, 1)]
    return (rows if how == "left" else rows.where("possible")).drop(*extra)


def sketch_bits(n: int, bits_per_row: int = BITS_PER_ROW, most_bits: int = MOST_BITS) -> int:
    return min(most_bits, max(LEAST_BITS, 1 << (n * bits_per_row).bit_length()))


def masked_rows(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, part, mask): one row per document with the failures of all five filters as bits 0 to 4."""
    text = F.coalesce("text", F.lit(""))
    hashes = [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2")]
    own = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_mask(text).alias("mask"), *hashes)
    own = materialise(own, "filter-rows")
    bits = sketch_bits(own.count(), most_bits=most_bits)
    words = materialise(repeated_words(own.select("h"), bits), "filter-sketch")
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    first = possible_repeats(texts, words, bits, "inner").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    first = first.select("doc_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2"), F.lit(True).alias("first"))
    judged = possible_repeats(own, words, bits, "left")
    keep = judged.where("NOT possible OR doc_id IS NULL").select("doc_id", "part", "mask")
    asked = judged.where("possible AND doc_id IS NOT NULL").join(first, ["doc_id", "h", "h2"], "left")
    return keep.union(asked.select("doc_id", "part", F.col("mask") + F.when(F.col("first"), 0).otherwise(16)))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the additive table behind every order."""
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).cast("bigint").alias(c)
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(one("quality"), one("toxic"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return rows.join(marks, "doc_id", "left").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("quality"), total("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """Per part, order and step what the filter removes, finds removed and costs, from (part, mask, n, quality, toxic)."""
    spark = counts.sparkSession
    sets = [(s, k, factorial(bin(s).count("1")) * factorial(4 - bin(s).count("1"))) for k in range(5) for s in range(32) if not s >> k & 1]
    cases = F.explode(F.array(*[F.struct(F.lit(s).alias("before"), F.lit(k).alias("filter"), F.lit(w).alias("weight")) for s, k, w in sets]))
    x = counts.withColumn("case", cases).select("*", "case.*", F.expr("mask & case.before").alias("gone"), F.expr("mask & shiftleft(1, case.filter)").alias("fails"))
    when = lambda condition, c="n": F.sum(F.when(F.expr(condition), F.col(c)).otherwise(F.lit(0).cast("bigint")))
    sums = x.groupBy("part", "before", "filter", "weight").agg(
        when("gone = 0 AND fails = 0").alias("kept"), when("gone = 0 AND fails <> 0").alias("removed"), when("gone <> 0 AND fails <> 0").alias("redundant"),
        when("mask = fails AND fails <> 0").alias("unique_fails"), when("gone = 0 AND fails <> 0", "quality").alias("good_lost"), when("gone = 0 AND fails <> 0", "toxic").alias("toxic_lost"),
    )
    sums = sums.withColumn("shapley", F.sum(F.col("removed") * F.col("weight")).over(Window.partitionBy("part", "filter")))
    steps = [("".join(FILTERS[k] for k in order), i + 1, sum(1 << k for k in order[:i]), order[i]) for order in permutations(range(5)) for i in range(5)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, before int, filter int")  # 600 rows
    return sums.join(F.broadcast(orders), ["before", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(docs: DataFrame, labels: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic)."""
    return audit(mask_counts(masked_rows(docs, most_bits), labels))


SQL = r"""WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CAST(len(ws) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INT) + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS INT)
  + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(min(w.doc_id) OVER (PARTITION BY t) < w.doc_id, false) AS INT) AS mask FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
b AS (SELECT chr(CAST(65 + i AS INT)) AS c, CAST(1 << i AS INT) AS v FROM range(5) r(i)),
p AS (SELECT a.c || b.c || d.c || e.c || g.c AS filter_order, [a.v, b.v, d.v, e.v, g.v] AS vs FROM b a, b b, b d, b e, b g WHERE a.v + b.v + d.v + e.v + g.v = 31 AND (a.v | b.v | d.v | e.v | g.v) = 31),
s AS (SELECT filter_order, CAST(i AS INT) AS step, CAST(coalesce(list_sum(vs[1:i - 1]), 0) AS INT) AS gone, vs[i] AS own FROM p, range(1, 6) r(i)),
x AS (SELECT part, filter_order, step, own, CAST(sum(CASE WHEN mask & (gone | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & gone = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN mask & gone <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN mask & gone = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & gone = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM m, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM x"""
