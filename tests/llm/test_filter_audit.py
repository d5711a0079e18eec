"""The filter audit against a plain count of every order, and its edge cases."""

from itertools import permutations

from pyspark.sql import functions as F

from corpusloom.llm import filter_audit as fa

SCHEMA = "doc_id bigint, text string, lang string, mask int, part string, h bigint"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def plain(rows, labels):
    """{(part, order, step): counts} by running every order over every row."""
    texts, marks = {}, {}
    for i, text, *_ in rows:
        if i is not None:
            texts[text or ""] = min(i, texts.get(text or "", i))
    for i, quality, toxic, _ in labels:
        if i is None:
            continue
        good, bad = marks.get(i, (False, False))
        marks[i] = good or quality == 1, bad or toxic == 1
    judged = []
    for i, text, lang, *_ in rows:
        t = text or ""
        words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in t).split(" ") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and texts[t] < i,
        }
        judged.append((lang or "", {k for k, v in fails.items() if v}, *marks.get(i, (False, False))))
    out = {}
    for order in permutations("ABCDE"):
        for step, own in enumerate(order, 1):
            for part in {j[0] for j in judged}:
                mine = [j for j in judged if j[0] == part]
                before = set(order[: step - 1])
                left = [j for j in mine if not j[1] & before]
                here = [j for j in left if own in j[1]]
                out[part, "".join(order), step] = [
                    len(left) - len(here), len(here), sum(own in j[1] and bool(j[1] & before) for j in mine), sum(j[1] == {own} for j in mine),
                    sum(j[2] for j in here), sum(j[3] for j in here),
                ]
    return out


def check(spark, rows, labels, **bounds):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = fa.filter_audit(docs, spark.createDataFrame(labels, LABELS), **bounds).collect()
    want = plain(rows, labels)
    assert {(r.part, r.filter_order, r.step): list(r[3:9]) for r in got} == want and len(got) == len(want)
    for r in got[::7]:
        own = r.filter_order[r.step - 1]
        assert r.shapley == sum(v[1] for (part, order, step), v in want.items() if part == r.part and order[step - 1] == own)


def rows_of(extra=()):
    long = " ".join(f"w{k}" for k in range(260))
    texts = [long, long + " X", "A B C", "a a a a", None, "", "p\x0bq r", long + " 5%", "é" * 30 + "A", long]
    rows = [(k, t, [None, "en", "de", ""][k % 4], 7, "x", 1) for k, t in enumerate(texts * 3)]
    return [*rows, *extra]


def test_every_order(spark):
    extra = [(None, "A B C", "en", 0, "", 0), (None, "only here", "en", 0, "", 0), (3, "a a a a", "de", 0, "", 0), (3, "other", "de", 0, "", 0), (1, "other", "de", 0, "", 0), (40, "x" * 300_000, "fr", 0, "", 0)]
    labels = [(0, 1, 0, ""), (0, 0, 1, ""), (2, None, 1, ""), (5, 1, None, ""), (None, 1, 1, ""), (999, 1, 1, ""), (8, 1, 1, "")]
    check(spark, rows_of(extra), labels)


def test_a_full_sketch_changes_nothing(spark):
    rows = [(k, f"text {k % 900}", "en", 0, "", 0) for k in range(1000)]
    check(spark, rows, [], most_bits=64)


def test_most_unique_texts_are_cleared(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 19_000).alias("text")).withColumn("h", F.xxhash64("text"))
    bits = fa.sketch_bits(20_000)
    possible = fa.possible_repeats(rows, fa.repeated_words(rows.select("h"), bits), bits, "inner")
    assert 2_000 <= possible.count() < 2_400 and possible.where("doc_id % 19000 < 1000").count() == 2_000


def test_empty(spark):
    assert fa.filter_audit(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).isEmpty()
