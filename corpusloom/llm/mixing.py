"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within a source the documents are laid out in key order; prefix sums of their
word counts tell where the source's budget ends. The sums are built in two levels: a source's key range is cut into
about sqrt(rows) equal ranges, so neither the list of range totals nor the one range that holds the cut grows past
about sqrt(rows), however large the source is. The result of that search is one small row per source, which is joined
to the documents; no document is shuffled with its text.

Defined cases: a null text counts 0 words; a null source is a source of its own, last in order; a null id gets the key
of the word "null"; rows that tie on key and id at the cut share what is left evenly, rounded down; an empty table gives
no rows. Added columns replace input columns of the same name; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, materialise

KEY_BITS = 52  # a key is 13 hexadecimal digits, exact in a double
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)


def word_count(text):
    """Number of runs of characters other than ASCII white space; 0 for null."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("bigint")


def random_key(doc_id, seed: str):
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(sources: DataFrame) -> DataFrame:
    """Add ``target`` to (src, n, source_size): weights 1, 2, 3 repeating in source order share the total, capped.

    A source whose share per weight would pass its cap (3 times its size) gets the cap. In order of cap per weight, the
    water level after k capped sources is (total - their caps) / (weight left); the first level that no further source
    stays below is the final one, which is what repeated resharing arrives at. One row per source goes through one task.
    """
    ordered = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    weighed = ordered.withColumn("w", w.cast("bigint")).withColumn("cap", F.lit(MOST_REPEATS) * F.col("source_size"))
    weighed = weighed.withColumn("ratio", F.col("cap").cast("double") / F.col("w").cast("double"))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    weighed = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps"),
    )
    room = (F.col("total") - F.col("caps")).cast("double")
    level = F.min(F.when(F.col("ratio") >= room / F.col("w_left").cast("double"), F.struct("ratio", "rank", room.alias("room"), F.col("w_left").cast("double").alias("left")))).over(everything)
    weighed = weighed.withColumn("level", level)
    capped = (F.col("ratio") < F.col("level.ratio")) | ((F.col("ratio") == F.col("level.ratio")) & (F.col("rank") < F.col("level.rank")))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(F.col("level.room") * F.col("w").cast("double") / F.col("level.left"))
    return weighed.select("rank", "src", "n", "source_size", target.alias("target"))


def mixing_plan(sized: DataFrame) -> DataFrame:
    """One row per source from (id, src, size, key): its target, whole epochs, and the key, id and words at the cut."""
    sources = sized.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    full = F.col("source_size")
    plan = source_targets(sources).withColumn("epochs", F.when(full > 0, F.floor(budget / full)).otherwise(0).cast("bigint"))
    plan = plan.withColumn("rest", budget - F.col("epochs") * full).withColumn("ranges", F.ceil(F.sqrt("n")).cast("bigint"))
    plan = materialise(plan, "mix-plan")
    cut_range = F.floor(F.col("key").cast("double") * F.col("ranges").cast("double") / F.lit(float(2**KEY_BITS))).cast("bigint")
    ranged = sized.join(plan.select("rank", F.col("src").alias("s"), "ranges", "rest"), F.col("src").eqNullSafe(F.col("s")))
    ranged = ranged.withColumn("range", cut_range)
    # totals of the ranges, summed before the shuffle; then the one range in which the rest of the budget ends
    totals = ranged.groupBy("rank", "range").agg(F.sum("size").alias("t"), F.first("rest").alias("rest"))
    upto = F.coalesce(F.sum("t").over(Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = totals.withColumn("before", upto).where("before <= rest AND rest < before + t").select("rank", "range", "rest", "before")
    inside = ranged.drop("rest").join(at, ["rank", "range"]).groupBy("rank", "key", "id", "rest", "before")
    inside = inside.agg(F.sum("size").alias("t"), F.count(F.lit(1)).alias("ties"))
    running = F.sum("t").over(Window.partitionBy("rank").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1))
    inside = inside.withColumn("start", F.col("before") + F.coalesce(running, F.lit(0)))
    cut = inside.where("start <= rest AND rest < start + t").select(
        "rank", F.col("key").alias("cut_key"), F.col("id").alias("cut_id"), F.floor((F.col("rest") - F.col("start")) / F.col("ties")).cast("bigint").alias("cut_words")
    )
    return plan.join(cut, "rank", "left").select("src", "source_size", "target", "epochs", "cut_key", "cut_id", "cut_words")


def mix_sources(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """Documents with size, source_size, target and taken (words the mix takes from the document, repeats counted)."""
    sized = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("src"), word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed).alias("key"))
    plan = mixing_plan(materialise(sized, "mix-sizes"))
    name = {c: fresh(c) for c in plan.columns}
    plan = materialise(plan.select([F.col(c).alias(n) for c, n in name.items()]), "mix-cuts")
    c = {k: F.col(v) for k, v in name.items()}
    size, key, words = fresh("size"), fresh("key"), fresh("taken")
    out = docs.join(plan, F.col("source").eqNullSafe(c["src"]), "left")
    out = out.withColumn(size, word_count(F.col("text"))).withColumn(key, random_key(F.col("doc_id"), seed))
    # order within a source is (key, id), a null id first
    tied = (F.col(key) == c["cut_key"]) & F.col("doc_id").eqNullSafe(c["cut_id"])
    earlier = (F.col(key) < c["cut_key"]) | ((F.col(key) == c["cut_key"]) & F.coalesce(F.col("doc_id") < c["cut_id"], F.col("doc_id").isNull()))
    part = F.when(c["cut_key"].isNull(), 0).when(tied, F.least(F.col(size), c["cut_words"])).when(earlier, F.col(size)).otherwise(0)
    out = out.withColumn(words, (c["epochs"] * F.col(size) + part).cast("bigint"))
    added = {"size": F.col(size), "source_size": c["source_size"], "target": c["target"], "taken": F.col(words)}
    return out.select(*[F.col(x) for x in docs.columns if x not in added], *[v.alias(k) for k, v in added.items()])


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS key
  FROM documents),
ranked AS (
  SELECT source, source_size, rank, (rank - 1) % 3 + 1 AS w, 3 * source_size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source)),
levels AS (
  SELECT *, cap::DOUBLE / w AS ratio, sum(source_size) OVER () AS total,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_left, coalesce(sum(cap) OVER b, 0) AS caps
  FROM ranked WINDOW b AS (ORDER BY cap::DOUBLE / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final_level AS (
  SELECT ratio AS l_ratio, rank AS l_rank, (total - caps)::DOUBLE AS room, w_left::DOUBLE AS w_room FROM levels
  WHERE ratio >= (total - caps)::DOUBLE / w_left::DOUBLE ORDER BY ratio, rank LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN ratio < l_ratio OR (ratio = l_ratio AND rank < l_rank) THEN cap::DOUBLE ELSE room * w::DOUBLE / w_room END AS target
  FROM levels, final_level),
laid AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE TIES), 0) - s.size AS start,
         count(*) OVER (PARTITION BY s.source, s.key, s.doc_id) AS ties, sum(s.size) OVER (PARTITION BY s.source, s.key, s.doc_id) AS tied
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
        + least(size, CASE WHEN budget % source_size >= start + tied THEN size ELSE greatest(0, (budget % source_size - start) // ties) END) END)::BIGINT AS taken
FROM laid
"""
