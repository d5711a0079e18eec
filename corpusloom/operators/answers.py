"""Prompts, deterministic answers, context-window checks, response re-use and claim triage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

# Price, limits, phrases and claim rules.
PRICE_PER_TOKEN = 0.00002
MAX_CONTEXT_TOKENS = 4096
NO_ANSWER = "I don't have enough information to answer that question."
NOT_FOUND = "I couldn't find relevant information to answer your question. Please try rephrasing or contact support."
DEFAULT_CUT = 300
CLAIM_LIMIT = 2000.0
AMOUNT = r"\$?([0-9]+[.,]?[0-9]*)"
SYSTEM_PROMPT = "Answer questions based on the context. Be concise."


def render_prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question, F.lit("\n\nAnswer: "))


def extractive_answer(context: Column) -> Column:
    """First sentence of the context, by full stop."""
    first = tx.strip(F.substring_index(tx.strip(context), ".", 1))
    return F.when(context.isNull(), F.lit(NO_ANSWER)).otherwise(F.concat(first, F.lit(".")))


def token_columns(df: DataFrame, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    return (
        df.withColumn("prompt_tokens", tx.word_count(F.col(prompt)))
        .withColumn("completion_tokens", tx.word_count(F.col(answer)))
        .withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
        .withColumn("cost_usd", F.col("total_tokens") * PRICE_PER_TOKEN)
    )


def model_answers(df: DataFrame, model: Callable[[list[str]], list[str]], prompt: str = "prompt") -> DataFrame:
    """Hook for a real model over Arrow batches; adds ``answer``."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(answer=pd.Series(model(pdf[prompt].tolist()), index=pdf.index, dtype=object))

    return df.mapInPandas(run, f"{_ddl(df)}, answer string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def context_window(df: DataFrame, prompt: str = "prompt", system_prompt: str = SYSTEM_PROMPT, max_tokens: int = MAX_CONTEXT_TOKENS) -> DataFrame:
    total = tx.word_count(F.col(prompt)) + len(system_prompt.split())
    return df.withColumn("window_tokens", total).withColumn("fits", total < max_tokens).withColumn("utilization", total / F.lit(float(max_tokens)))


def routed_answer(hits: DataFrame, questions: DataFrame, routes: Sequence[tuple[Sequence[str], Sequence[str], str]]) -> DataFrame:
    """Rule-routed answers.

    Each route is (question words, text words, prefix). The first route, in order, whose word is in the
    question and whose text word is in a hit answers with its best such hit; else the first two hits are cut
    to 300 characters.
    """
    q, t = F.lower("question"), F.lower("content")
    route, prefix = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i in reversed(range(len(routes))):
        asks, has, lead = routes[i]
        match = tx.any_of(q, asks) & tx.any_of(t, has)
        route, prefix = F.when(match, F.lit(i)).otherwise(route), F.when(match, F.lit(lead)).otherwise(prefix)
    per_query = (
        hits.join(questions, "query_id")
        .withColumn("route", route)
        .withColumn("lead", prefix)
        .groupBy("query_id")
        .agg(
            F.min(F.when(F.col("route").isNotNull(), F.struct("route", "rank", "lead", "content"))).alias("best"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= 2, F.struct("rank", "content")))), lambda x: x["content"]), " "
            ).alias("first_two"),
        )
    )
    answer = F.when(F.col("best").isNotNull(), F.concat("best.lead", F.lit(": "), "best.content")).otherwise(
        F.concat(F.lit("Based on the available information: "), F.substring("first_two", 1, DEFAULT_CUT), F.lit("..."))
    )
    return questions.select("query_id").join(per_query, "query_id", "left").select(
        "query_id", F.col("best.route").alias("route"),
        F.when(F.col("first_two").isNull(), F.lit(NOT_FOUND)).otherwise(answer).alias("answer"),
    )


def answer_batch(questions: DataFrame, contexts: DataFrame, max_tokens: int = MAX_CONTEXT_TOKENS) -> DataFrame:
    """Question and context to a logged answer row. Overflowing prompts are logged, not answered."""
    joined = questions.join(contexts, "query_id", "left").withColumn("prompt", render_prompt(F.col("question"), F.coalesce("context", F.lit(""))))
    checked = context_window(joined, max_tokens=max_tokens)
    answered = checked.withColumn("answer", F.when(F.col("fits"), extractive_answer(F.col("context"))))
    return token_columns(answered.withColumn("error", F.when(~F.col("fits"), "Context window overflow")))


def reuse_key(text: Column) -> Column:
    return F.md5(F.lower(tx.strip(text)))


def response_reuse(requests: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds ``prompt_key``, ``is_hit`` and ``answered_by``, the first request with the same question.

    The first id per key is a partial aggregate, so a question asked by a third of all requests
    is reduced before the shuffle.
    """
    keyed = requests.select(id_col, reuse_key(F.col(text_col)).alias("prompt_key"))
    first = keyed.groupBy("prompt_key").agg(F.min(id_col).alias("answered_by"))
    return keyed.join(first, "prompt_key").withColumn("is_hit", F.col(id_col) != F.col("answered_by"))


def reuse_summary(requests: DataFrame, text_col: str) -> DataFrame:
    """Hits, misses and hit rate: every first occurrence of a key is a miss."""
    per_key = requests.groupBy(reuse_key(F.col(text_col)).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total, misses = F.sum("n"), F.count(F.lit(1))
    return per_key.agg(misses.alias("misses"), (total - misses).alias("hits"), ((total - misses) * F.lit(100.0) / total).alias("hit_rate"))


def triage_claims(
    claims: DataFrame, policies: DataFrame, limit: float = CLAIM_LIMIT, tiers: tuple[float, float] = (1000.0, 2000.0), incident_words: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Inactive or unknown policy rejects, else a cost above the limit goes to manual review."""
    cost = F.col("estimated_cost")
    amount = F.regexp_extract(F.concat(F.lit("Estimate: $"), cost.cast("decimal(18,2)").cast("string")), AMOUNT, 1).cast("double")
    decision = F.when(~F.col("active"), "Reject").when(amount > limit, "Manual Review").otherwise("Auto-Approve")
    severity = F.when(amount <= tiers[0], "low").when(amount <= tiers[1], "medium").otherwise("high")
    incident = F.lit("other")
    for name, words in (incident_words or {}).items():
        incident = F.when(tx.any_of(F.lower("description"), words), F.lit(name)).otherwise(incident)
    return (
        claims.join(policies, "policy_id", "left")
        .withColumn("active", F.coalesce("active", F.lit(False)))
        .select(
            "claim_id", "policy_id", "active", incident.alias("incident"), severity.alias("severity"), decision.alias("decision"),
            F.when(decision == "Manual Review", "PENDING").otherwise("CLOSED").alias("final_status"),
        )
    )
