"""Grounding, response checks, failure classes, configuration comparison and release decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import patterns as pt
from corpusloom.functions import text as tx
from corpusloom.operators.answers import PRICE_PER_TOKEN
from corpusloom.operators.quantiles import as_row

# Signal thresholds and confidences.
SHORT_CONTEXT_WORDS = 20
GROUNDED_BELOW, RELEVANT_BELOW = 0.3, 0.2
LOW_RISK, MEDIUM_RISK = 0.5, 0.3
FAILURES = {"RETRIEVAL_FAILURE": 0.8, "MODEL_FAILURE": 0.7, "PROMPT_FAILURE": 0.6, "NO_CLEAR_FAILURE": 0.5}
DEFAULT_SCORE = 3
PRICE_PER_1K = 0.002
MONTHLY_QUERIES = 1000


def at_least_one(n: Column) -> Column:
    return F.greatest(n, F.lit(1))


def grounding_signals(qa: DataFrame) -> DataFrame:
    """Adds length and term-overlap signals to (question, context, answer) rows."""
    terms = {c: tx.terms_without(F.col(c), pt.SIGNAL_STOP) for c in ("question", "context", "answer")}
    marked = qa.select("*", *[t.alias(f"_{c}") for c, t in terms.items()])
    n_ctx, n_ans = tx.word_count(F.col("context")), tx.word_count(F.col("answer"))

    def overlap(side: str) -> Column:
        return F.size(F.array_intersect(f"_{side}", "_context")) / at_least_one(F.size(f"_{side}"))

    return (
        marked.withColumn("context_words", n_ctx)
        .withColumn("answer_words", n_ans)
        .withColumn("context_too_short", F.col("context_words") < SHORT_CONTEXT_WORDS)
        .withColumn("answer_context_ratio", F.col("answer_words") / at_least_one(F.col("context_words")))
        .withColumn("answer_longer", F.col("answer_words") > F.col("context_words"))
        .withColumn("grounded_ratio", overlap("answer"))
        .withColumn("potential_hallucination", F.col("grounded_ratio") < GROUNDED_BELOW)
        .withColumn("context_relevance", overlap("question"))
        .withColumn("irrelevant_context", F.col("context_relevance") < RELEVANT_BELOW)
        .drop("_question", "_context", "_answer")
    )


def grounding_risk(pairs: DataFrame, response: str = "answer", context: str = "context", threshold: float = MEDIUM_RISK) -> DataFrame:
    """Share of the response's terms found in the context, and the risk level."""
    marked = pairs.withColumn("_r", tx.terms_without(F.col(response), pt.GROUNDING_STOP)).withColumn(
        "_c", tx.terms_without(F.col(context), pt.GROUNDING_STOP)
    )
    shared = F.size(F.array_intersect("_r", "_c"))
    overlap = F.when(F.size("_r") == 0, 1.0).otherwise(shared / F.size("_r"))
    risk = F.when(F.col("overlap") >= LOW_RISK, "LOW").when(F.col("overlap") >= threshold, "MEDIUM").otherwise("HIGH")
    return (
        marked.withColumn("response_terms", F.size("_r").cast("bigint"))
        .withColumn("matching_terms", shared.cast("bigint"))
        .withColumn("overlap", overlap)
        .withColumn("risk", risk)
        .withColumn("grounded", F.col("risk") != "HIGH")
        .drop("_r", "_c")
    )


def hallucination_rate(risks: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return risks.agg(
        n.alias("total_checks"), F.count(F.when(~F.col("grounded"), 1)).alias("ungrounded"),
        (F.count(F.when(~F.col("grounded"), 1)) * F.lit(100.0) / n).alias("hallucination_rate"),
        F.count(F.when(F.col("risk") == "HIGH", 1)).alias("high_risk"),
    )


def response_checks(answers: DataFrame, chunks: Column) -> DataFrame:
    """Refusal or a full chunk in the answer, safe wording, and no hedging."""
    low = F.lower("answer")
    quoted = F.exists(chunks, lambda c: F.contains(low, F.lower(c)))
    return (
        answers.withColumn("grounding", F.contains("answer", F.lit(pt.REFUSAL)) | quoted)
        .withColumn("safety", tx.any_of(low, [p.lower() for p in pt.SAFETY_PHRASES]))
        .withColumn("hallucination_prevention", ~tx.any_of(low, pt.HEDGING_PHRASES))
    )


def classify_failures(signals: DataFrame, grounded_score: str, correct_score: str) -> DataFrame:
    kind = (
        F.when(F.col("irrelevant_context"), "RETRIEVAL_FAILURE")
        .when(F.col("potential_hallucination"), "MODEL_FAILURE")
        .when((F.col(grounded_score) >= 4) & (F.col(correct_score) <= 2), "PROMPT_FAILURE")
        .otherwise("NO_CLEAR_FAILURE")
    )
    confidence = F.lit(None).cast("double")
    for name, value in FAILURES.items():
        confidence = F.when(F.col("failure_type") == name, F.lit(value)).otherwise(confidence)
    return signals.withColumn("failure_type", kind).withColumn("confidence", confidence)


def failure_distribution(failures: DataFrame, keys: Sequence[str], example: str) -> DataFrame:
    """Count, percent and one example per type; the example is the one with the lowest key."""
    per_type = failures.groupBy("failure_type").agg(
        F.count(F.lit(1)).alias("failures"), F.min_by(example, F.struct(*keys)).alias("example")
    )
    total = as_row(failures.agg(F.count(F.lit(1)).alias("n")))["n"]
    return per_type.withColumn("percent", F.col("failures") * F.lit(100.0) / total)


def keyword_match(answers: DataFrame, expected: Column) -> DataFrame:
    """Percent of expected keywords found in the answer, ignoring case."""
    found = F.size(F.filter(expected, lambda k: F.contains(F.lower("answer"), F.lower(k))))
    return answers.withColumn("match_rate", F.when(F.size(expected) > 0, found * F.lit(100.0) / F.size(expected)))


def clamp_score(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(DEFAULT_SCORE)).otherwise(F.least(F.greatest(c, F.lit(1)), F.lit(5)))


def score_means(scored: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(clamp_score(F.col(c))).alias(f"{c}_mean") for c in columns]
    )


def signal_vs_score(signals: DataFrame, score: str) -> DataFrame:
    flags = ("context_too_short", "answer_longer", "potential_hallucination", "irrelevant_context")
    return signals.agg(
        F.count(F.lit(1)).alias("samples"),
        *[F.count(F.when(F.col(f), 1)).alias(f"n_{f}") for f in flags],
        F.avg(F.when(F.col("potential_hallucination"), F.col(score))).alias("score_with_flag"),
        F.avg(F.when(~F.col("potential_hallucination"), F.col(score))).alias("score_without_flag"),
    )


def compare_configs(runs: DataFrame, config: str, baseline: object) -> DataFrame:
    """``runs``: (config, query_id, tokens, docs). Costs per config against a baseline config."""
    per = runs.groupBy(config).agg(
        F.count(F.lit(1)).alias("queries"), F.sum("tokens").alias("total_tokens"), F.avg("tokens").alias("avg_tokens"),
        F.max("tokens").alias("max_tokens"), F.min("tokens").alias("min_tokens"), F.avg("docs").alias("avg_docs"),
    )
    base = as_row(
        runs.where(F.col(config) == baseline).agg((F.sum("tokens") * PRICE_PER_TOKEN).alias("cost"), F.count(F.lit(1)).alias("n"))
    )
    cost = F.col("total_tokens") * PRICE_PER_TOKEN
    return per.select(
        "*", cost.alias("total_cost"), (cost / base["n"]).alias("cost_per_query"),
        F.round(cost / base["cost"] * 100, 1).alias("relative_cost_pct"),
        (cost / F.col("queries") * MONTHLY_QUERIES).alias("monthly_cost"),
    )


def optimisation_saving(rows: DataFrame) -> DataFrame:
    """``rows``: (baseline_tokens, optimized_tokens)."""
    b, o = F.sum("baseline_tokens"), F.sum("optimized_tokens")
    return rows.agg(
        F.count(F.lit(1)).alias("queries"), b.alias("baseline_tokens"), o.alias("optimized_tokens"),
        F.avg(F.col("baseline_tokens") - F.col("optimized_tokens")).alias("avg_reduction"),
        ((b - o) / at_least_one(b) * 100).alias("reduction_pct"),
        ((b - o) / 1000 * PRICE_PER_1K).alias("cost_saving"),
    )


def deploy_decision(baseline: DataFrame, optimized: DataFrame, by: Sequence[str]) -> DataFrame:
    """Percent changes of quality, grounding, p95 latency and tokens, then the first matching rule.

    Each side has one row per key with ``correctness_mean, groundedness_mean, latency_p95, avg_tokens``.
    """
    metrics = {
        "quality": "correctness_mean", "groundedness": "groundedness_mean", "latency": "latency_p95", "cost": "avg_tokens",
    }
    side = lambda df, tag: df.select(*by, *[F.col(m).cast("double").alias(f"{tag}_{n}") for n, m in metrics.items()])
    both = side(baseline, "b").join(side(optimized, "o"), list(by))
    deltas = both.select(
        *by,
        *[((F.col(f"o_{n}") - F.col(f"b_{n}")) / F.greatest(F.col(f"b_{n}"), F.lit(1.0)) * 100).alias(f"{n}_change_pct") for n in metrics],
    )
    q, g, c = F.col("quality_change_pct"), F.col("groundedness_change_pct"), F.col("cost_change_pct")
    tolerable = (q >= -5) & (g >= -10)
    rules = [
        ((q > -1) & (c <= -30), "DEPLOY", 0.95, "LOW"),
        (tolerable & (c <= -40), "DEPLOY", 0.85, "LOW-MEDIUM"),
        (tolerable & (c <= -20), "DEPLOY", 0.75, "MEDIUM"),
        ((q < -10) | (g < -15), "REJECT", 0.90, "HIGH"),
        (c > -20, "REJECT", 0.80, "N/A"),
    ]
    out = F.struct(F.lit("REVIEW").alias("recommendation"), F.lit(0.60).alias("confidence"), F.lit("MEDIUM").alias("risk"))
    for cond, rec, conf, risk in reversed(rules):
        out = F.when(cond, F.struct(F.lit(rec).alias("recommendation"), F.lit(conf).alias("confidence"), F.lit(risk).alias("risk"))).otherwise(out)
    return deltas.withColumn("_d", out).select("*", "_d.*").drop("_d")


def relevant_in_corpus(eval_set: DataFrame, corpus: DataFrame, ids: str = "relevant_doc_ids", key: str = "doc_id") -> DataFrame:
    """Per question: how many of its relevant ids are in the corpus."""
    wanted = eval_set.select("query_id", F.explode_outer(ids).alias(key))
    here = corpus.select(key, F.lit(1).alias("_in"))
    return wanted.join(here, key, "left").groupBy("query_id").agg(F.count(key).alias("relevant"), F.count("_in").alias("indexed"))


def gram_hashes(df: DataFrame, key: str, text_col: str, n: int) -> DataFrame:
    """Rows (key, a, b): two 64-bit hashes of each lower-case token n-gram, repeats included. No gram is built as a string."""
    tokens = F.coalesce(tx.tokens(F.lower(text_col)), F.array().cast("array<string>"))

    def grams(words):
        at = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
        parts = lambda i: [F.get(words, i + k) for k in range(n)]
        return F.transform(at, lambda i: F.struct(F.xxhash64(*parts(i)).alias("a"), F.xxhash64(F.lit(n), *parts(i)).alias("b")))

    # the word hashes are computed once, in the one element of an array; repeats are left to the callers' hashed distinct,
    # since array_distinct compares struct elements pairwise, quadratic in a document's length
    found = F.element_at(F.transform(F.array(F.transform(tokens, lambda t: F.xxhash64(t))), grams), 1)
    return df.select(key, F.explode(found).alias("g")).select(key, "g.*")


def ngram_containment(items: DataFrame, corpus: DataFrame, item_key: str, item_text: str, corpus_key: str, corpus_text: str, n: int = 5) -> DataFrame:
    """Share of an item's distinct n-grams that occur in the corpus. Grams are equal when their 128 bits of hashes are.

    Corpus n-grams are 16 bytes each, meet the items' distinct n-grams in a semi-join and are reduced to distinct ones
    before anything else, so copies in the corpus never multiply. With few items Spark tests them where the corpus is scanned.
    """
    wanted = gram_hashes(items, item_key, item_text, n).distinct()
    found = gram_hashes(corpus, corpus_key, corpus_text, n).join(wanted.select("a", "b").distinct(), ["a", "b"], "left_semi").select("a", "b").distinct()
    per_item = wanted.join(found.withColumn("_f", F.lit(1)), ["a", "b"], "left").groupBy(item_key).agg(
        F.count(F.lit(1)).alias("grams"), F.count("_f").alias("grams_found")
    )
    return per_item.withColumn("containment", F.col("grams_found") / F.col("grams"))
