"""Vector, keyword and hybrid retrieval, fallbacks, context assembly and retrieval measures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators.topk import CosineScorer, TermScorer, top_hits

# Stop words, weights and parameters of the retrievers.
RELEVANCE_STOP = "what is are the a an how do does can for to of in on at".split()
HYBRID_STOP = "what how is the a an to do i for in of".split()
SEMANTIC_WEIGHT, KEYWORD_WEIGHT = 0.7, 0.3
FALLBACK_SCORE = 0.5
ADAPTIVE_WORDS = {
    "troubleshooting": ("troubleshoot", "fix", "error", "issue", "problem"),
    "specific": ("error", "code", "api", "endpoint", "command"),
    "broad": ("overview", "explain", "describe", "what is"),
}
ADAPTIVE_PARAMS = {"troubleshooting": (7, 5000), "specific": (3, 2000), "broad": (5, 4000), "default": (5, 3000)}
SWEEP_CONFIGS = ((3, 2000), (5, 4000), (8, 6000))
MIN_TAIL = 100


# ---- vector search

def vector_search(vectors: DataFrame, queries: DataFrame, k: int, filtered: bool = False, exclude_self: bool = True, floor: float | None = None, **limits) -> DataFrame:
    """``vectors``: (id, embedding[, category]); ``queries``: (query_id, query_vec[, category]). Null vectors match nothing."""
    vectors, queries = (side.where(F.col(side.columns[1]).isNotNull()) for side in (vectors, queries))
    return top_hits(vectors, queries, partial(CosineScorer, filtered=filtered, exclude_self=exclude_self, floor=floor), k, **limits)


def cosine(a: Column, b: Column) -> Column:
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def assign_cells(vectors: DataFrame, cells: int = 16, seed: int = 42, iterations: int = 5) -> tuple[DataFrame, DataFrame]:
    """(vectors with their k-means ``cell``, cell centres). Write the first partitioned by ``cell`` to prune scans."""
    key, emb = vectors.columns[:2]
    as_vector = array_to_vector(F.transform(emb, lambda x: x.cast("double")))
    features = vectors.select(key, emb, as_vector.alias("_v"))
    model = KMeans(k=cells, featuresCol="_v", predictionCol="cell", seed=seed, maxIter=iterations).fit(features)
    centres = vectors.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell bigint, centre array<double>"
    )
    return model.transform(features).select(key, emb, "cell"), centres


def approximate_search(celled: DataFrame, centres: DataFrame, queries: DataFrame, k: int, probes: int = 6, **limits) -> DataFrame:
    """Top-k among the vectors of the ``probes`` cells nearest to each query; other cells are not scored."""
    qid, vec = queries.columns[:2]
    near = vector_search(centres, queries.select(qid, vec), probes, exclude_self=False).select("query_id", F.col("hit_id").cast("int").alias("cell"))
    probed = queries.select(F.col(qid).alias("query_id"), F.col(vec).alias("query_vec")).join(near, "query_id")
    return vector_search(celled, probed, k, filtered=True, **limits)


def recall_at_k(found: DataFrame, exact: DataFrame) -> DataFrame:
    hit = found.select("query_id", "hit_id").withColumn("_f", F.lit(1))
    return exact.join(hit, ["query_id", "hit_id"], "left").agg(
        F.count(F.lit(1)).alias("expected"), F.count("_f").alias("found"), (F.count("_f") / F.count(F.lit(1))).alias("recall")
    )


# ---- keyword search

def corpus_terms(docs: DataFrame, with_title: bool = False) -> DataFrame:
    """(doc_id, distinct lower-case tokens[, title tokens]); the text itself goes no further."""
    cols = [F.array_distinct(tx.tokens(F.lower("content"))).alias("tokens")]
    if with_title:
        cols.append(F.array_distinct(tx.tokens(F.lower("title"))).alias("title_tokens"))
    return docs.select("doc_id", *cols)


def keyword_search(docs: DataFrame, queries: DataFrame, k: int, title_weight: float = 0.0, positive_only: bool = True, any_hit: float | None = None, **limits) -> DataFrame:
    """``queries``: (query_id, terms, divisor). Substring hits count; ties keep document order."""
    make = partial(TermScorer, title_weight=title_weight, positive_only=positive_only, any_hit=any_hit)
    return top_hits(corpus_terms(docs, title_weight > 0), queries, make, k, **limits)


def _query(questions: DataFrame, terms: Column, divisor: Column | float = 1.0) -> DataFrame:
    div = divisor if isinstance(divisor, Column) else F.lit(float(divisor))
    return questions.withColumn("terms", terms).select("query_id", "terms", div.cast("double").alias("divisor"))


def relevance_query(questions: DataFrame, stop: Sequence[str] = RELEVANCE_STOP) -> DataFrame:
    """Distinct word runs without stop words."""
    words = F.array_distinct(tx.words(F.lower("question")))
    return _query(questions, F.array_except(words, F.array(*[F.lit(s) for s in stop])))


def bag_query(questions: DataFrame) -> DataFrame:
    """All whitespace tokens; a repeated token counts each time."""
    return _query(questions, tx.tokens(F.lower("question")))


def like_query(questions: DataFrame) -> DataFrame:
    """First five tokens longer than three letters; if there is none, the first three tokens."""
    toks = tx.tokens(F.lower("question"))
    long = F.slice(F.filter(toks, lambda t: F.length(t) > 3), 1, 5)
    return _query(questions, F.when(F.size(long) > 0, long).otherwise(F.slice(toks, 1, 3)))


def fraction_query(questions: DataFrame) -> DataFrame:
    long = F.filter(tx.tokens(F.lower("question")), lambda t: F.length(t) > 3)
    return _query(questions, long, F.greatest(F.size(F.col("terms")), F.lit(1)))


def relevance_search(docs: DataFrame, questions: DataFrame, k: int = 3, **limits) -> DataFrame:
    """Content hits plus twice the title hits; zero scores may fill up the list."""
    return keyword_search(docs, relevance_query(questions), k, title_weight=2.0, positive_only=False, **limits)


def bag_search(docs: DataFrame, questions: DataFrame, k: int = 3, **limits) -> DataFrame:
    return keyword_search(docs, bag_query(questions), k, **limits)


def any_term_search(docs: DataFrame, questions: DataFrame, k: int = 5, all_terms: bool = False, **limits) -> DataFrame:
    """OR over terms with a fixed score, lowest ids first."""
    q = bag_query(questions) if all_terms else like_query(questions)
    return keyword_search(docs, q, k, any_hit=FALLBACK_SCORE, **limits)


def fraction_search(docs: DataFrame, questions: DataFrame, k: int = 5, **limits) -> DataFrame:
    return keyword_search(docs, fraction_query(questions), k, **limits)


# ---- combination

def with_text(hits: DataFrame, docs: DataFrame, *columns: str) -> DataFrame:
    """Join document columns to hits after top-k, so that text never enters the scoring scan."""
    return hits.join(docs.select(F.col("doc_id").alias("hit_id"), *columns), "hit_id")


def hybrid_search(vectors: DataFrame, queries: DataFrame, docs: DataFrame, k: int = 5, semantic: float = SEMANTIC_WEIGHT, keyword: float = KEYWORD_WEIGHT, **limits) -> DataFrame:
    """Take 2k by vector among vectors with a document, then rank by a weighted sum of cosine and the share of query terms found."""
    wide = vector_search(vectors.join(docs.select(F.col("doc_id").alias(vectors.columns[0])), vectors.columns[0], "left_semi"), queries.select("query_id", "query_vec"), 2 * k, **limits)
    terms = queries.select("query_id", tx.terms_without(F.col("question"), HYBRID_STOP).alias("terms"))
    found = F.size(F.filter("terms", lambda t: F.contains(F.lower("content"), t)))
    share = F.when(F.size("terms") > 0, found / F.size("terms")).otherwise(0.0)
    scored = (
        with_text(wide, docs, "content")
        .join(terms, "query_id")
        .select(
            "query_id", "hit_id", F.col("score").alias("semantic_score"), F.round(share, 6).alias("keyword_score"),
            F.round(semantic * F.col("score") + keyword * share, 6).alias("combined_score"),
        )
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("combined_score"), "hit_id")
    return scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)


def cascade_search(questions: DataFrame, vector_hits: DataFrame, keyword_hits: DataFrame) -> DataFrame:
    """Per question the vector hits, else the keyword hits, else one row tagged ``none``."""
    served = vector_hits.select("query_id").distinct()
    backup = keyword_hits.join(served, "query_id", "left_anti")
    both = vector_hits.withColumn("source", F.lit("vector")).unionByName(backup.withColumn("source", F.lit("keyword")))
    return questions.select("query_id").join(both, "query_id", "left").withColumn("source", F.coalesce("source", F.lit("none")))


def adaptive_parameters(queries: DataFrame, text_col: str, words=ADAPTIVE_WORDS, params=ADAPTIVE_PARAMS) -> DataFrame:
    """Query type with its k and context limit; the first matching type wins."""
    q = F.lower(text_col)
    kind = F.lit("default")
    for name in ("broad", "specific", "troubleshooting"):
        kind = F.when(tx.any_of(q, words[name]), F.lit(name)).otherwise(kind)
    out = queries.withColumn("query_type", kind)
    for i, col in enumerate(("top_k", "max_context")):
        value = F.lit(params["default"][i])
        for name in ("troubleshooting", "specific", "broad"):
            value = F.when(F.col("query_type") == name, F.lit(params[name][i])).otherwise(value)
        out = out.withColumn(col, value)
    return out


def assemble_context(hits: DataFrame, limit: int | Column, keys: Sequence[str] = ("query_id",), joiner: str = "\n\n") -> DataFrame:
    """Labelled passages in rank order up to a character budget.

    ``hits`` has the keys, ``rank``, ``title`` and ``content``. The passage that passes the limit is cut to
    what is left, if more than 100 characters are left, and ends the context. Joiners are not counted.
    """
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    order = Window.partitionBy(*keys).orderBy("rank")
    passage = F.concat(F.lit("[Document "), F.col("rank").cast("string"), F.lit(": "), F.col("title"), F.lit("]\n"), F.col("content"))
    before = F.coalesce(F.sum(F.length("passage")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = limit - F.col("before")
    kept = F.when(F.length("passage") <= left, F.col("passage")).when(
        (left > MIN_TAIL), F.concat(F.substring("passage", F.lit(1), left.cast("int")), F.lit("..."))
    )
    return (
        hits.withColumn("passage", passage)
        .withColumn("before", before)
        .withColumn("kept", kept)
        .groupBy(*keys)
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.when(F.col("kept").isNotNull(), F.struct("rank", "kept")))), lambda x: x["kept"]), joiner
            ).alias("context"),
            F.count("kept").alias("passages"),
        )
    )


def config_sweep(hits: DataFrame, configs: Sequence[tuple[int, int]] = SWEEP_CONFIGS) -> DataFrame:
    """Contexts of one ranked pass under several (k, max_chars) settings."""
    options = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).alias("max_chars")) for k, c in configs])
    wide = hits.withColumn("cfg", F.explode(options)).where(F.col("rank") <= F.col("cfg.k")).select(
        "*", F.col("cfg.k").alias("top_k"), F.col("cfg.max_chars").alias("max_chars")
    )
    return assemble_context(wide, F.col("max_chars"), keys=["query_id", "top_k", "max_chars"])


def conflict_pairs(hits: DataFrame, bound: float = 0.5) -> DataFrame:
    """Pairs of hits of one query with similar but unequal text. A query has at most k hits."""
    per_query = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("hit_id", "content", F.array_distinct(tx.tokens(F.lower("content"))).alias("terms")))).alias("h")
    )
    left = per_query.select("query_id", F.explode("h").alias("a"), "h")
    pairs = left.select("query_id", "a", F.explode(F.filter("h", lambda b: b["hit_id"] > F.col("a.hit_id"))).alias("b"))
    shared, merged = F.size(F.array_intersect("a.terms", "b.terms")), F.size(F.array_union("a.terms", "b.terms"))
    return (
        pairs.withColumn("similarity", F.when(merged > 0, shared / merged).otherwise(0.0))
        .where((F.col("similarity") >= bound) & (F.col("a.content") != F.col("b.content")))
        .select("query_id", F.col("a.hit_id").alias("first_id"), F.col("b.hit_id").alias("second_id"), "similarity")
    )


# ---- measures

def per_query_relevance(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """``hits`` has ``rank`` and boolean ``relevant``. Queries without hits stay, as misses."""
    sums = hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("returned"),
        F.count(F.when(F.col("relevant"), 1)).alias("relevant_count"),
        F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first_rank"),
    )
    joined = queries.select("query_id").join(sums, "query_id", "left")
    return joined.select(
        "query_id",
        F.coalesce(F.col("relevant_count") > 0, F.lit(False)).alias("hit"),
        F.coalesce(F.col("relevant_count") / F.col("returned"), F.lit(0.0)).alias("precision_score"),
        "first_rank",
    )


def retrieval_measures(per_query: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return per_query.agg(
        n.alias("queries"),
        (F.count(F.when(F.col("hit"), 1)) / n).alias("hit_rate"),
        F.avg("precision_score").alias("mean_precision"),
        (F.coalesce(F.sum(1 / F.col("first_rank")), F.lit(0.0)) / n).alias("mrr"),
    )
