"""Prompt validation, risk detection, PII detection and masking, rate checks and guardrail audit.

Patterns run with Unicode classes, as the patterns were meant. Everything is a column expression except
the span offsets, which need a matcher and run over Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import patterns as pt
from corpusloom.functions import text as tx
from corpusloom.operators.sweep import running_sums

MIN_CHARS, MAX_CHARS, MAX_SPECIAL = 10, 5000, 0.3
MAX_TOKENS = 4000
UNICODE = "(?U)"
MONITOR_LIMITS = (("guardrail_block_rate", 0.5), ("pii_detection_rate", 5.0), ("avg_prompt_length", 5000.0))
MINUTE, HOUR = 60_000_000, 3_600_000_000
SPAN_TYPE = "array<struct<entity_type:string,start:int,end:int,text:string>>"


def literal_head(pattern: str) -> str:
    """The literal text a pattern starts with, or an empty string. Patterns with alternatives outside groups have none."""
    if "|" in re.sub(r"\([^()]*\)", "", pattern):
        return ""
    head = re.match(r"[A-Za-z0-9<;]*", pattern).group()
    return head[:-1] if pattern[len(head) : len(head) + 1] in ("?", "*", "{") and head else head


def any_pattern(c: Column, patterns: Sequence[str]) -> Column:
    """Whether one of the patterns occurs, ignoring case.

    A plain substring test for a pattern's literal start comes first and spares most texts the regular expression.
    """
    low, hit = F.lower(c), F.lit(False)
    for p in patterns:
        found = F.rlike(c, F.lit("(?i)" + p))
        head = literal_head(p).lower()
        hit = hit | ((F.contains(low, F.lit(head)) & found) if head else found)
    return hit


# ---- validation and risks

def special_ratio(c: Column) -> Column:
    """Share of characters that are neither letters, digits nor blanks."""
    return F.length(F.regexp_replace(c, r"[\p{L}\p{N}\p{Z} \t\n\r\f]+", "")) / F.length(c)


def validate_prompt(c: Column, prohibited: Sequence[str] = pt.PROHIBITED_PATTERNS) -> Column:
    """struct(valid, flag, text): the first failed check names the flag; a too long text is cut."""
    which = F.lit(None).cast("string")
    for p in reversed(prohibited):
        which = F.when(any_pattern(c, [p]), F.lit(f"PROHIBITED_PATTERN: {p}")).otherwise(which)
    flag = (
        F.when(F.length(c) < MIN_CHARS, "TOO_SHORT")
        .when(F.length(c) > MAX_CHARS, "TOO_LONG")
        .when(any_pattern(c, prohibited), which)
        .when(special_ratio(c) > MAX_SPECIAL, "EXCESSIVE_SPECIAL_CHARS")
        .otherwise("PASSED")
    )
    text = F.when(F.length(c) > MAX_CHARS, F.substring(c, 1, MAX_CHARS)).otherwise(c)
    return F.struct((flag == "PASSED").alias("valid"), flag.alias("flag"), text.alias("text"))


def detect_risks(c: Column, pii_count: Column, token_count: Column, groups: Mapping[str, Sequence[str]] = pt.RISK_PATTERNS) -> Column:
    """Sorted array of distinct risks."""
    found = [F.when(any_pattern(c, p), F.lit(risk)) for risk, p in groups.items()]
    found.append(F.when(pii_count > 0, F.lit("pii_exposure")))
    found.append(F.when(token_count > MAX_TOKENS, F.lit("token_waste")))
    return F.array_sort(F.array_compact(F.array(*found)))


def select_actions(risks: Column, rules: Mapping[str, Sequence[str]] = pt.RISK_ACTIONS) -> Column:
    """Actions of all risks in priority order, each once. An unknown risk asks for a warning."""
    known = F.array(*[F.lit(r) for r in rules])
    out = []
    for action in pt.ACTION_NOTES:
        wanted = F.arrays_overlap(risks, F.array(*[F.lit(r) for r, acts in rules.items() if action in acts]))
        if action == "warn":
            wanted = wanted | (F.size(F.array_except(risks, known)) > 0)
        out.append(F.when(wanted, F.lit(action)))
    return F.array_compact(F.array(*out))


def apply_actions(df: DataFrame, text_col: str, actions: str) -> DataFrame:
    """Adds ``allowed``, ``processed`` and ``notes``: BLOCK empties the text and ends; MASK, FILTER and COMPRESS change it."""
    has = lambda action: F.array_contains(actions, action)
    notes = F.array_compact(F.array(*[F.when(has(a), F.lit(n)) for a, n in pt.ACTION_NOTES.items()]))
    out = df.withColumn("allowed", ~has("block")).withColumn("processed", F.when(F.col("allowed"), F.col(text_col)).otherwise(""))
    for action, change in (("mask", mask_replace), ("filter", substitute), ("compress", tx.squeeze)):
        out = out.withColumn("processed", F.when(F.col("allowed") & has(action), change(F.col("processed"))).otherwise(F.col("processed")))
    return out.withColumn("notes", F.when(F.col("allowed"), notes).otherwise(F.array(F.lit(pt.ACTION_NOTES["block"]))))


# ---- PII

def pii_regex(profile: Mapping[str, tuple[str, str]], faithful: bool = False) -> dict[str, str]:
    """Type to Java pattern. Profile B ignores case, by default not for names and places."""
    cased = profile is not pt.PII_B
    return {
        t: ("" if cased or (t in pt.CASED_TYPES and not faithful) else "(?i)") + UNICODE + p for t, (p, _) in profile.items()
    }


def may_hold(c: Column, entity_type: str) -> Column:
    """Cheap necessary condition of a type: an at sign, a digit, or nothing for names."""
    if entity_type == "EMAIL_ADDRESS":
        return F.contains(c, F.lit("@"))
    if entity_type.startswith("PERSON"):
        return F.lit(True)
    return F.rlike(c, F.lit(r"\p{Nd}"))


def pii_count(c: Column, profile=pt.PII_A) -> Column:
    n = F.lit(0)
    for t, p in pii_regex(profile).items():
        n = n + F.when(may_hold(c, t), F.regexp_count(c, F.lit(p))).otherwise(0)
    return n.cast("bigint")


def any_pii(c: Column, profile=pt.PII_A, faithful: bool = False) -> Column:
    hit = F.lit(False)
    for t, p in pii_regex(profile, faithful).items():
        hit = hit | (may_hold(c, t) & F.rlike(c, F.lit(p)))
    return hit


def pii_spans(df: DataFrame, keys: Sequence[str], text_col: str, profile=pt.PII_A, faithful: bool = False) -> DataFrame:
    """Rows (keys, entity_type, ordinal, entity): every match, numbered per type."""
    c, none = F.col(text_col), F.array().cast("array<string>")
    per_type = F.array(*[
        F.struct(F.lit(t).alias("entity_type"), F.when(may_hold(c, t), F.regexp_extract_all(c, F.lit(p), F.lit(0))).otherwise(none).alias("found"))
        for t, p in pii_regex(profile, faithful).items()
    ])
    return (
        df.select(*keys, F.explode(per_type).alias("p"))
        .select(*keys, "p.entity_type", F.posexplode("p.found").alias("ordinal", "entity"))
    )


def pii_offsets(df: DataFrame, keys: Sequence[str], text_col: str, profile=pt.PII_A, faithful: bool = False) -> DataFrame:
    """Rows (keys, entity_type, start, end, entity) with character offsets. Only texts with a match leave the JVM."""
    compiled = [
        (t, re.compile(p, re.IGNORECASE if profile is pt.PII_B and (faithful or t not in pt.CASED_TYPES) else 0)) for t, (p, _) in profile.items()
    ]

    def spans(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda s: sorted(
                ({"entity_type": t, "start": m.start(), "end": m.end(), "text": m.group()} for t, r in compiled for m in r.finditer(s)),
                key=lambda d: d["start"],
            ),
            na_action="ignore",
        )

    return (
        df.where(any_pii(F.col(text_col), profile, faithful))
        .select(*keys, F.explode(F.pandas_udf(spans, SPAN_TYPE)(text_col)).alias("s"))
        .select(*keys, "s.entity_type", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.text").alias("entity"))
    )


def mask_replace(c: Column, profile=pt.PII_A) -> Column:
    """Each match becomes its type's token, type by type in profile order."""
    out = c
    for t, p in pii_regex(profile).items():
        out = F.regexp_replace(out, p, profile[t][1].replace("$", r"\$"))
    return F.when(any_pii(c, profile), out).otherwise(c)


def mask_matches(c: Column, mode: str, profile=pt.PII_A) -> Column:
    """``hash``: 16 hex digits of SHA-256. ``redact``: a star per character.

    All types are one alternation, so overlapping spans resolve to the leftmost, then to profile order, and the
    text is rebuilt from the pieces between the matches.
    """
    pattern = "|".join(f"(?:{p})" for p in pii_regex(profile).values())
    rest = F.split(c, pattern, -1)
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    if mode == "hash":
        masked = F.transform(found, lambda m: F.substring(F.sha2(m, 256), 1, 16))
    elif mode == "redact":
        masked = F.transform(found, lambda m: F.repeat(F.lit("*"), F.length(m)))
    else:
        raise ValueError(f"unknown mode {mode}")
    pieces = F.zip_with(rest, F.concat(masked, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(any_pii(c, profile), F.array_join(pieces, "")).otherwise(c)


def pii_statistics(df: DataFrame, text_col: str, profile=pt.PII_A) -> DataFrame:
    n = df.select(pii_count(F.col(text_col), profile).alias("n"))
    return n.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total_entities"), F.avg("n").alias("avg_per_document"),
        F.count(F.when(F.col("n") > 0, 1)).alias("documents_with_pii"),
    )


def pii_distribution(df: DataFrame, text_col: str, profile=pt.PII_A) -> DataFrame:
    """Entities and documents by type, from per-row counts instead of exploded matches."""
    counts = F.array(*[
        F.struct(F.lit(t).alias("entity_type"), F.when(may_hold(F.col(text_col), t), F.regexp_count(text_col, F.lit(p))).otherwise(0).alias("n"))
        for t, p in pii_regex(profile).items()
    ])
    return (
        df.select(F.explode(counts).alias("c")).where(F.col("c.n") > 0)
        .groupBy(F.col("c.entity_type").alias("entity_type"))
        .agg(F.sum("c.n").alias("entities"), F.count(F.lit(1)).alias("documents"))
        .orderBy(F.desc("entities"), "entity_type")
    )


# ---- compliant substitution

def may_match(c: Column, pattern: str) -> Column:
    """Cheap necessary condition of a restricted pattern."""
    if "@" in pattern:
        return F.contains(c, F.lit("@"))
    if pattern.startswith(r"\$"):
        return F.contains(c, F.lit("$"))
    if pattern.startswith(r"\b\d"):
        return F.rlike(c, F.lit(r"\p{Nd}"))
    head = literal_head(pattern).lower()
    return F.contains(F.lower(c), F.lit(head)) if head else F.lit(True)


def restricted_matches(c: Column, rules=pt.RESTRICTED) -> Column:
    """Array of 'category: match → token' in rule order."""

    def noted(category: str, token: str):
        return lambda m: F.concat(F.lit(category + ": "), m, F.lit(" → " + token))

    parts, none = [], F.array().cast("array<string>")
    for category, (patterns, token) in rules.items():
        for p in patterns:
            hits = F.regexp_extract_all(c, F.lit("(?i)" + UNICODE + p), F.lit(0))
            parts.append(F.when(may_match(c, p), F.transform(hits, noted(category, token))).otherwise(none))
    return F.concat(*parts)


def substitute(c: Column, rules=pt.RESTRICTED) -> Column:
    out, hit = c, F.lit(False)
    for patterns, token in rules.values():
        for p in patterns:
            found = "(?i)" + UNICODE + p
            hit = hit | (may_match(c, p) & F.rlike(c, F.lit(found)))
            out = F.regexp_replace(out, found, token)
    return F.when(hit, out).otherwise(c)


def compliant_documents(df: DataFrame, text_col: str = "content") -> DataFrame:
    made = restricted_matches(F.col(text_col))
    return (
        df.withColumn("compliant_content", substitute(F.col(text_col)))
        .withColumn("substitutions", F.array_join(made, "; "))
        .withColumn("restricted_items", F.size(made).cast("bigint"))
        .withColumn("compliance_status", F.when(F.col("restricted_items") > 0, "FILTERED").otherwise("CLEAN"))
    )


# ---- rate check

def offered_load(
    log: DataFrame, user: str, clock: Column, tokens: Column, counted: Column | None = None,
    request_window: int = MINUTE, token_window: int = HOUR, max_requests: int = 10, max_tokens: int = 100_000,
) -> DataFrame:
    """Requests and tokens a user offered just before each row, flagged against limits.

    ``clock`` is in microseconds. Every row loads its windows when it comes and takes its load away when it leaves them, so the
    loads are running sums over these events. Rows with ``counted`` false are judged but do not load the windows.
    """
    counted = F.lit(True) if counted is None else counted
    rows = log.select("*", clock.alias("_t"), tokens.cast("bigint").alias("_n"), counted.alias("_c"))
    one = F.when(F.col("_c"), 1).otherwise(0).cast("bigint")
    load = F.when(F.col("_c"), F.coalesce("_n", F.lit(0))).otherwise(0).cast("bigint")
    none = F.lit(0).cast("bigint")

    def event(at, kind, requests, tokens_, row):
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), requests.alias("requests_before"), tokens_.alias("tokens_before"), row.alias("row"))

    whole = F.struct(*log.columns, "_n", one.alias("_one"), load.alias("_load"))
    gone = F.when(F.lit(False), whole)
    # what leaves a window at some time is gone before what comes at that time is judged
    events = F.array(event(F.col("_t"), 1, one, load, whole), event(F.col("_t") + request_window, 0, -one, none, gone), event(F.col("_t") + token_window, 0, none, -load, gone))
    swept = running_sums(rows.select(F.col(user).alias("_user"), F.explode(events).alias("_e")).select("_user", "_e.*"), ["_user"], ["at", "kind"], ["requests_before", "tokens_before"])
    judged = swept.where("row IS NOT NULL").select("row.*", "requests_before", "tokens_before")
    judged = judged.withColumn("requests_before", F.col("requests_before") - F.col("_one")).withColumn("tokens_before", F.col("tokens_before") - F.col("_load"))
    status = (
        F.when(F.col("requests_before") >= max_requests, "RATE_LIMIT_EXCEEDED")
        .when(F.col("tokens_before") + F.col("_n") > max_tokens, "TOKEN_LIMIT_EXCEEDED")
        .otherwise("ALLOWED")
    )
    return judged.withColumn("rate_status", status).drop("_n", "_one", "_load")


# ---- audit

def guardrail_audit(
    log: DataFrame, user: str, text_col: str, clock: Column, tokens: Column, prohibited: Sequence[str] = pt.PROHIBITED_PATTERNS, **limits
) -> DataFrame:
    """Validate, then rate-check the valid prompts, then mask. One audit row per prompt; a prompt that
    fails a stage takes no part in the later ones."""
    checked = log.withColumn("_v", validate_prompt(F.col(text_col), prohibited))
    rated = offered_load(checked, user, clock, tokens, counted=F.col("_v.valid"), **limits)
    ok, admitted = F.col("_v.valid"), F.col("rate_status") == "ALLOWED"
    passed = ok & admitted
    return rated.select(
        *log.columns,
        F.when(passed, "SUCCESS").otherwise("BLOCKED").alias("status"),
        F.when(~ok, "Invalid prompt").when(~admitted, "Rate limit exceeded").otherwise("").alias("reason"),
        F.when(~ok, F.col("_v.flag")).when(~admitted, F.col("rate_status")).otherwise("PASSED").alias("flags"),
        F.when(passed, pii_count(F.col(text_col))).alias("pii_detected"),
        F.when(passed, mask_replace(F.col(text_col))).alias("masked_text"),
    )


def guardrail_metrics(audit: DataFrame, text_col: str) -> DataFrame:
    """Block rate, PII per passed prompt and mean prompt length against their thresholds."""
    m = audit.agg(
        F.avg(F.when(F.col("status") != "SUCCESS", 1.0).otherwise(0.0)).alias("guardrail_block_rate"),
        F.coalesce(F.avg("pii_detected"), F.lit(0.0)).alias("pii_detection_rate"),
        F.avg(F.length(text_col)).alias("avg_prompt_length"),
    )
    rows = F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("metric_value"), F.lit(t).alias("threshold")) for n, t in MONITOR_LIMITS])
    return m.select(F.explode(rows).alias("m")).select(
        "m.*", F.when(F.col("m.metric_value") > F.col("m.threshold"), "ALERT").otherwise("NORMAL").alias("status")
    )


def role_filter(df: DataFrame, role_col: str, roles: Sequence[str], name: str = "role_allowed") -> DataFrame:
    """Row filter by a temporary SQL function."""
    allowed = ", ".join("'" + r.replace("'", "''") + "'" for r in roles)
    df.sparkSession.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(user_role STRING) RETURNS BOOLEAN RETURN user_role IN ({allowed})")
    return df.where(F.expr(f"{name}({role_col})"))


def filter_quality(scored: DataFrame, flagged: Column, truth: Column) -> DataFrame:
    """Confusion counts, precision and recall of a filter against labels."""
    c = scored.agg(
        F.count(F.when(flagged & truth, 1)).alias("true_pos"), F.count(F.when(flagged & ~truth, 1)).alias("false_pos"),
        F.count(F.when(~flagged & truth, 1)).alias("false_neg"), F.count(F.when(~flagged & ~truth, 1)).alias("true_neg"),
    )
    found, real = F.col("true_pos") + F.col("false_pos"), F.col("true_pos") + F.col("false_neg")
    return c.withColumn("precision_score", F.when(found > 0, F.col("true_pos") / found).otherwise(0.0)).withColumn(
        "recall_score", F.when(real > 0, F.col("true_pos") / real).otherwise(0.0)
    )
