"""URL rules behind a blocked Bloom filter, with DataFrame functions only.

A list entry is a canonical (host, path). It covers its host with all subdomains and every path that starts with its
path. A url is cut into the candidate entries that could cover it: for each shape (number of host labels, path length)
on the list, the host's last labels and the path's first characters; with a list of very many shapes, for each host ending and
each path beginning of the url itself. A blocked Bloom filter, one 512-bit block per key, passes the possible hits; an exact
join with the list removes false positives. The filter has about 16 bits an entry and at most ``MOST_BLOCKS`` blocks, so
what is broadcast is bounded: a list beyond that only passes more false positives to the exact join.

Defined cases: a null url and a url without "://" have an empty host and path and match nothing; equal urls are judged
once; ties in length cannot differ in entry; empty tables give no rows. Added columns replace input columns of the name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, lower_ascii, materialise

WORDS = 8  # 64-bit words in a block
MOST_SHAPES = 4096  # beyond, the candidates come from the url alone
MOST_BLOCKS = 1 << 17  # of 72 bytes in the broadcast
BLOCK_ENTRIES = 32


def url_parts(url):
    """(host, path) columns: the host after the first "://" with A-Z lower-cased, the path up to "?" or "#"."""
    text = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def _block(host, path, blocks: int):
    return F.pmod(F.xxhash64(F.lit("block"), host, path), F.lit(blocks))


def _bits(host, path):
    """One bit in each word of the block."""
    h = F.xxhash64(F.lit("bits"), host, path)
    return [_one_bit(F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63))) for i in range(WORDS)]


def _one_bit(position):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position.cast("int"))


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7): the filter over (host, path), at most ``blocks`` rows of 72 bytes, merged before the shuffle."""
    host, path = F.col("host"), F.col("path")
    marked = entries.select(_block(host, path, blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(host, path))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def shapes_of(entries: DataFrame, most: int = MOST_SHAPES) -> list[tuple[int, int]] | None:
    """Distinct (host labels, path length) of the list; None if there are more than ``most``."""
    found = entries.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).distinct().limit(most + 1).collect()
    return sorted((r[0], r[1]) for r in found) if len(found) <= most else None


def candidates(shapes: list[tuple[int, int]] | None):
    """The candidate entries (host, path) of a url (h, p), distinct."""
    if shapes is not None:
        return F.array_distinct(F.array(*[F.struct(F.substring_index("h", ".", -n).alias("host"), F.substring("p", 1, k).alias("path")) for n, k in shapes]))
    # every ending of the host at a dot with every beginning of the path
    labels = F.split("h", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    paths = F.transform(F.sequence(F.lit(0), F.length("p")), lambda k: F.substring(F.col("p"), F.lit(1), k))
    return F.flatten(F.transform(hosts, lambda host: F.transform(paths, lambda path: F.struct(host.alias("host"), path.alias("path")))))


def filter_urls(pages: DataFrame, entries: DataFrame, otherwise: str = "allow", blocks: int | None = None, most_shapes: int = MOST_SHAPES) -> DataFrame:
    """Pages with host, path, rule and verdict. ``entries``: (host, path, verdict, named).

    The longest covering entry decides. ``rule`` names it if it is ``named``; entries that are not (a plain list of bad
    sites) count only where no named one covers the url. Urls that no entry covers get ``otherwise``.
    """
    host, path = fresh("host"), fresh("path")
    split = url_parts(F.col("url"))
    judged = pages.withColumn(host, split[0]).withColumn(path, split[1])
    urls = judged.select(F.col(host).alias("h"), F.col(path).alias("p")).where("h <> ''").distinct()
    shapes = shapes_of(entries, most_shapes)
    blocks = blocks or min(MOST_BLOCKS, max(1, -(-entries.count() // BLOCK_ENTRIES)))
    hits = urls.limit(0).select("h", "p", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    if shapes != []:
        tried = urls.select("h", "p", F.explode(candidates(shapes)).alias("t")).select("h", "p", "t.host", "t.path")
        tried = tried.withColumn("block", _block(F.col("host"), F.col("path"), blocks))
        tests = [F.col(f"w{i}").bitwiseAND(b) != 0 for i, b in enumerate(_bits(F.col("host"), F.col("path")))]
        possible = tried.join(F.broadcast(bloom_blocks(entries, blocks)), "block")
        for test in tests:
            possible = possible.where(test)
        exact = possible.select("h", "p", "host", "path").join(entries, ["host", "path"])
        best = F.max(F.struct(F.col("named").cast("int").alias("named"), F.length(F.concat("host", "path")).alias("n"), F.length("host").alias("l"), F.concat("host", "path").alias("rule"), "verdict"))
        hits = exact.groupBy("h", "p").agg(best.alias("b")).select("h", "p", F.when(F.col("b.named") == 1, F.col("b.rule")).alias("rule"), "b.verdict")
    h, p, rule, verdict = fresh("h"), fresh("p"), fresh("rule"), fresh("verdict")
    hits = materialise(hits, "url-hits").toDF(h, p, rule, verdict)
    out = judged.join(hits, (F.col(host) == F.col(h)) & (F.col(path) == F.col(p)), "left")
    added = {"host": F.col(host), "path": F.col(path), "rule": F.col(rule), "verdict": F.coalesce(F.col(verdict), F.lit(otherwise))}
    return out.select(*[F.col(c) for c in pages.columns if c not in added], *[v.alias(k) for k, v in added.items()])


# The rules of the query, and sites that are blocked where no rule applies.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
BAD_SITES = (("spam-farm.example.org", "/"), ("spam-farm.example.net", "/"))

SQL = r"""
WITH rules(host, path, verdict, named) AS (VALUES
  ('com', '/', 'allow', 1), ('example.com', '/en/', 'block', 1), ('www.example.com', '/en/', 'allow', 1),
  ('net', '/es/', 'block', 1), ('net', '/fr/', 'block', 1),
  ('spam-farm.example.org', '/', 'block', 0), ('spam-farm.example.net', '/', 'block', 0)),
cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path FROM cut),
urls AS (SELECT DISTINCT host, path FROM parts),
hits AS (
  SELECT u.host, u.path, r.host || r.path AS rule, r.verdict, r.named,
         row_number() OVER (PARTITION BY u.host, u.path ORDER BY r.named DESC, length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT p.page_id, p.host, p.path, CASE WHEN h.named = 1 THEN h.rule END AS rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON p.host = h.host AND p.path = h.path AND h.k = 1
"""
