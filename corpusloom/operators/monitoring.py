"""Metrics, thresholds, anomalies, alerts and diagnoses over an inference log.

The log has ``request_id, ts, user_id, category, complexity, status, latency_ms, input_tokens,
output_tokens, total_tokens, quality_score``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.quantiles import as_row, exact_percentiles
from corpusloom.operators.sweep import running_sums

# Thresholds, rules and prices of the monitored service.
SLOW_THRESHOLDS = {"simple": 500.0, "moderate": 1000.0, "complex": 2000.0}
DEFAULT_SLOW = 1000.0
PRICE_IN_PER_1K = 0.0015
PRICE_OUT_PER_1K = 0.002
WEEK_HOURS = 168
ALERT_RULES = (
    ("latency_critical", "critical", "P99 latency exceeds 2x baseline"),
    ("latency_warning", "warning", "P95 latency exceeds 1.5x baseline"),
    ("error_rate_critical", "critical", "Error rate exceeds 10%"),
    ("error_rate_warning", "warning", "Error rate exceeds 5%"),
    ("token_spike", "warning", "Average token usage exceeds P95 baseline"),
    ("quality_degradation", "warning", "Average quality score below threshold"),
)
COOLDOWN_SECONDS = {"critical": 300, "warning": 900, "info": 3600}


def share(cond: Column) -> Column:
    """Fraction of rows for which a condition holds."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def metric_columns(hours: float = WEEK_HOURS) -> list[Column]:
    count = F.count(F.lit(1))
    return [
        F.avg("latency_ms").alias("latency_mean"),
        F.stddev("latency_ms").alias("latency_std"),
        count.alias("total_requests"),
        (count / F.lit(float(hours))).alias("requests_per_hour"),
        share(F.col("status") == "success").alias("success_rate"),
        share(F.col("status") == "error").alias("error_rate"),
        F.avg("input_tokens").alias("avg_input_tokens"),
        F.avg("output_tokens").alias("avg_output_tokens"),
        F.avg("total_tokens").alias("avg_total_tokens"),
        F.sum("total_tokens").alias("total_tokens_consumed"),
        F.avg("quality_score").alias("avg_quality_score"),
        share(F.col("quality_score") < 0.7).alias("quality_below_threshold"),
        share(F.col("complexity") == "simple").alias("pct_simple"),
        share(F.col("complexity") == "moderate").alias("pct_moderate"),
        share(F.col("complexity") == "complex").alias("pct_complex"),
    ]


def traffic_metrics(log: DataFrame, by: Sequence[str] = (), hours: float = WEEK_HOURS) -> DataFrame:
    wanted = {"latency_p50": 0.5, "latency_p95": 0.95, "latency_p99": 0.99}
    return exact_percentiles(log, "latency_ms", wanted, by=by, extra=metric_columns(hours))


def latency_by(log: DataFrame, key: str) -> DataFrame:
    return exact_percentiles(
        log, "latency_ms", {"median_latency": 0.5, "p95_latency": 0.95}, by=[key],
        extra=[F.avg("latency_ms").alias("mean_latency")],
    )


def hourly_profile(log: DataFrame) -> DataFrame:
    return log.groupBy(F.hour("ts").alias("hour_of_day")).agg(
        F.avg("latency_ms").alias("mean_latency"), F.count(F.lit(1)).alias("requests")
    )


def flag_slow(log: DataFrame, limits: Mapping[str, float] = SLOW_THRESHOLDS, default: float = DEFAULT_SLOW) -> DataFrame:
    limit = F.lit(float(default))
    for level, ms in limits.items():
        limit = F.when(F.col("complexity") == level, F.lit(float(ms))).otherwise(limit)
    return log.withColumn("is_slow", F.col("latency_ms") > limit)


def sigma_outliers(log: DataFrame, sigmas: float = 3.0) -> DataFrame:
    stats = log.agg(F.avg("latency_ms").alias("mean"), F.stddev("latency_ms").alias("std"))
    cut = as_row(stats.select((F.col("mean") + sigmas * F.col("std")).alias("cut")))["cut"]
    return log.where(F.col("latency_ms") > cut)


def baseline_thresholds(log: DataFrame) -> DataFrame:
    """One row of latency, token and error-rate thresholds."""
    lat = exact_percentiles(
        log, "latency_ms", {"latency_p25": 0.25, "latency_p75": 0.75, "latency_p95": 0.95, "latency_p99": 0.99},
        extra=[
            F.avg("latency_ms").alias("latency_mean"),
            F.stddev("latency_ms").alias("latency_std"),
            F.avg("total_tokens").alias("tokens_mean"),
            F.stddev("total_tokens").alias("tokens_std"),
            share(F.col("status") == "error").alias("error_baseline"),
        ],
    )
    tok = exact_percentiles(log, "total_tokens", {"tokens_p95": 0.95, "tokens_p99": 0.99})
    iqr = F.col("latency_p75") - F.col("latency_p25")
    return lat.withColumn("t", as_row(tok)).select(
        "latency_mean", "latency_std", "latency_p95", "latency_p99",
        (F.col("latency_p25") - 1.5 * iqr).alias("latency_iqr_low"),
        (F.col("latency_p75") + 1.5 * iqr).alias("latency_iqr_high"),
        "tokens_mean", "tokens_std", "t.tokens_p95", "t.tokens_p99", "error_baseline",
        F.greatest(F.lit(0.05), 2 * F.col("error_baseline")).alias("error_threshold"),
    )


def anomalies(log: DataFrame, baseline: DataFrame, latency_sigmas: float = 3.0, token_sigmas: float = 2.0) -> DataFrame:
    """Rows (kind, request_id, value, score), one per request and violated test."""
    b = F.col("b")
    lat, tok = F.col("latency_ms"), F.col("total_tokens")
    # a constant measure has no deviation: its score is null and no row is reported
    z_lat = F.try_divide(lat - b["latency_mean"], b["latency_std"])
    z_tok = F.try_divide(tok - b["tokens_mean"], b["tokens_std"])
    def found(cond, kind, value, score):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), value.cast("double").alias("value"), score.alias("score")))
    checks = F.array_compact(F.array(
        found(F.abs(z_lat) > latency_sigmas, "latency_zscore", lat, z_lat),
        found(lat > b["latency_p99"], "latency_percentile", lat, F.try_divide(lat, b["latency_p99"])),
        found(lat > b["latency_iqr_high"], "latency_iqr", lat, F.try_divide(lat, b["latency_iqr_high"])),
        found(F.abs(z_tok) > token_sigmas, "token_zscore", tok, z_tok),
    ))
    return (
        log.withColumn("b", as_row(baseline))
        .select("request_id", F.explode(checks).alias("a"))
        .select("a.kind", "request_id", "a.value", "a.score")
    )


def top_anomalies(found: DataFrame, kinds: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` highest scores of each kind, by top-k selection."""
    parts = [
        found.where(F.col("kind") == kind).orderBy(F.desc(F.round("score", 6)), "request_id").limit(n) for kind in kinds
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def error_rate_check(log: DataFrame, baseline: DataFrame) -> DataFrame:
    b = as_row(baseline)
    return log.agg(share(F.col("status") == "error").alias("current_error_rate")).select(
        "current_error_rate",
        b["error_threshold"].alias("error_threshold"),
        (F.col("current_error_rate") > b["error_threshold"]).alias("is_anomaly"),
    )


def evaluate_alerts(metrics: DataFrame, baseline: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per triggered rule and metrics row."""
    b = F.col("b")
    conditions = {
        "latency_critical": F.col("latency_p99") > b["latency_p99"] * 2,
        "latency_warning": F.col("latency_p95") > b["latency_p95"] * 1.5,
        "error_rate_critical": F.col("error_rate") > 0.10,
        "error_rate_warning": F.col("error_rate") > 0.05,
        "token_spike": F.col("avg_total_tokens") > b["tokens_p95"],
        "quality_degradation": F.coalesce(F.col("avg_quality_score"), F.lit(1.0)) < 0.7,
    }
    fired = [
        F.when(conditions[rule], F.struct(F.lit(rule).alias("rule"), F.lit(sev).alias("severity"), F.lit(msg).alias("message")))
        for rule, sev, msg in ALERT_RULES
    ]
    return (
        metrics.withColumn("b", as_row(baseline))
        .select(*keep, F.explode(F.array_compact(F.array(*fired))).alias("a"))
        .select(*keep, "a.rule", "a.severity", "a.message")
    )


def windowed_metrics(log: DataFrame, width: str = "1 hour") -> DataFrame:
    windowed = log.withColumn("window_start", F.window("ts", width)["start"])
    return traffic_metrics(windowed, by=["window_start"], hours=1.0)


def token_usage(log: DataFrame) -> DataFrame:
    """Token use by complexity and by category in one pass with grouping sets, rounded to 2 digits."""
    grouped = log.groupingSets([["complexity"], ["category"]], "complexity", "category").agg(
        F.round(F.avg("input_tokens"), 2).alias("input_mean"),
        F.round(F.avg("output_tokens"), 2).alias("output_mean"),
        F.round(F.avg("total_tokens"), 2).alias("total_mean"),
        F.sum("total_tokens").alias("total_sum"),
        F.count(F.lit(1)).alias("requests"),
        F.grouping("complexity").alias("_g"),
    )
    return grouped.select(
        F.when(F.col("_g") == 0, "complexity").otherwise("category").alias("dimension"),
        F.when(F.col("_g") == 0, F.col("complexity")).otherwise(F.col("category")).alias("member"),
        "input_mean", "output_mean", "total_mean", "total_sum", "requests",
    )


def token_cost(log: DataFrame, decile: float = 0.9) -> DataFrame:
    """Top-decile threshold, its share of requests and tokens, and the cost of all requests."""
    cut = as_row(exact_percentiles(log, "total_tokens", {"cut": decile}))["cut"]
    high = F.col("total_tokens") > cut
    n = F.count(F.lit(1))
    return log.agg(
        F.first(cut).alias("high_threshold"),
        F.count(F.when(high, 1)).alias("high_requests"),
        (share(high) * 100).alias("high_request_pct"),
        (F.coalesce(F.sum(F.when(high, F.col("total_tokens"))), F.lit(0)) / F.sum("total_tokens") * 100).alias("high_token_pct"),
        (F.sum("input_tokens") / 1000 * PRICE_IN_PER_1K + F.sum("output_tokens") / 1000 * PRICE_OUT_PER_1K).alias("total_cost"),
        n.alias("requests"),
    )


def period_review(current: DataFrame, baseline: DataFrame, alerts: DataFrame) -> DataFrame:
    """Change of four metrics against a baseline metrics row, with status, advice and overall health."""
    names = ["latency_p50", "latency_p95", "avg_total_tokens", "error_rate"]
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"b.{m}").alias("baseline"), F.col(m).alias("current")) for m in names
    ])
    change = F.when(F.col("baseline") > 0, (F.col("current") - F.col("baseline")) / F.col("baseline") * 100).otherwise(0.0)
    status = F.when(F.abs("change_pct") < 20, "OK").when(F.col("change_pct") > 0, "DEGRADED").otherwise("IMPROVED")
    advice = {
        "latency_p95": ("HIGH", "Latency"),
        "avg_total_tokens": ("MEDIUM", "Cost"),
        "error_rate": ("HIGH", "Reliability"),
    }
    degraded = F.col("status") == "DEGRADED"
    priority, area = F.lit(None).cast("string"), F.lit(None).cast("string")
    for metric, (p, a) in advice.items():
        hit = degraded & (F.col("metric") == metric)
        priority, area = F.when(hit, p).otherwise(priority), F.when(hit, a).otherwise(area)
    a = as_row(alerts.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("severity") == "critical", 1)).alias("critical")
    ))
    return (
        current.withColumn("b", as_row(baseline))
        .select(F.explode(pairs).alias("m")).select("m.*")
        .withColumn("change_pct", change)
        .withColumn("status", status)
        .withColumn("priority", priority)
        .withColumn("area", area)
        .withColumn("health", F.when(a["n"] > 0, "NEEDS_ATTENTION").otherwise("HEALTHY"))
        .withColumn("critical_alerts", a["critical"])
    )


def spike_analysis(log: DataFrame, bottleneck_pct: Column | None = None) -> DataFrame:
    """Spike rate, variance, queue-wait estimate and a health score out of 100."""
    p = as_row(exact_percentiles(log, "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}))
    n = F.count(F.lit(1))
    base = log.agg(
        F.first(p["p50"]).alias("p50"), F.first(p["p95"]).alias("p95"), F.first(p["p99"]).alias("p99"),
        F.max("latency_ms").alias("max_latency"),
        (F.count(F.when(F.col("latency_ms") > 2 * p["p50"], 1)) * F.lit(100.0) / n).alias("spike_rate"),
        F.var_pop("latency_ms").alias("latency_variance"),
    ).withColumn("queue_wait", F.greatest(F.lit(0.0), (F.col("p95") - F.col("p50")) * 0.3))
    score = (
        F.lit(100)
        - F.when(F.col("spike_rate") > 10, 20).otherwise(0)
        - F.when(F.col("queue_wait") > 0.5, 20).otherwise(0)
    )
    if bottleneck_pct is not None:
        score = score - F.when(bottleneck_pct > 80, 15).otherwise(0)
    return base.withColumn("health_score", score)


def stage_profile(stages: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, p95 per stage and for the total, the share of all time, and the slowest stage."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("stage"), col.alias("seconds"))
        for name, col in [*[(c, F.col(c)) for c in columns], ("total", total)]
    ])).alias("s")
    long = stages.select(rows).select("s.*")
    prof = exact_percentiles(
        long, "seconds", {"p50_s": 0.5, "p95_s": 0.95}, by=["stage"],
        extra=[F.avg("seconds").alias("mean_s"), F.sum("seconds").alias("sum_s")],
    )
    sums = as_row(stages.agg(
        F.sum(total).alias("all"), *[F.sum(c).alias(c) for c in columns]
    ))
    slowest, top = F.lit(columns[0]), sums[columns[0]]
    for c in columns[1:]:
        slowest = F.when(sums[c] > top, F.lit(c)).otherwise(slowest)
        top = F.greatest(top, sums[c])
    return prof.select(
        "stage", "mean_s", "p50_s", "p95_s", (F.col("sum_s") / sums["all"] * 100).alias("share_pct"),
        (F.col("stage") == slowest).alias("is_bottleneck"),
    )


def service_dashboard(log: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    minutes = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 60e6
    return exact_percentiles(
        log, "latency_ms", {"p50_latency": 0.5, "p95_latency": 0.95, "p99_latency": 0.99},
        extra=[
            n.alias("total_requests"),
            (share(F.col("status") == "success") * 100).alias("success_pct"),
            F.avg("latency_ms").alias("avg_latency"),
            F.max("latency_ms").alias("max_latency"),
            F.count(F.when(F.col("status") == "error", 1)).alias("error_count"),
            F.sum("total_tokens").alias("total_tokens"),
            (n / F.greatest(F.lit(1.0), minutes)).alias("requests_per_minute"),
        ],
    )


def nearest_rank_p95(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return exact_percentiles(log, "latency_ms", {"p95_nearest": 0.95}, by=by, method="nearest")


def issue_list(checks: Sequence[tuple[Column, str | Column]]) -> Column:
    texts = [F.when(cond, F.lit(t) if isinstance(t, str) else t) for cond, t in checks]
    return F.array_join(F.array_compact(F.array(*texts)), ", ")


def _verdict(df: DataFrame, check: str, issues: Column) -> DataFrame:
    return df.withColumn("check", F.lit(check)).withColumn("issues", issues).withColumn(
        "status", F.when(F.col("issues") == "", "HEALTHY").otherwise("ISSUES_FOUND")
    )


def diagnose_latency(log: DataFrame, sla_ms: float = 2000.0, high_ms: float = 1000.0) -> DataFrame:
    m = exact_percentiles(
        log, "latency_ms", {"p95_latency_ms": 0.95}, method="nearest",
        extra=[F.avg("latency_ms").alias("avg_latency_ms"), F.max("latency_ms").alias("max_latency_ms")],
    )
    issues = issue_list([
        (F.col("max_latency_ms") > F.col("avg_latency_ms") * 3, "LATENCY_SPIKE_DETECTED"),
        (F.col("p95_latency_ms") > sla_ms, "P95_EXCEEDS_SLA"),
        (F.col("avg_latency_ms") > high_ms, "HIGH_AVERAGE_LATENCY"),
    ])
    return _verdict(m, "latency", issues)


def diagnose_retrieval(per_query: DataFrame, minimum: float = 2.0) -> DataFrame:
    """``per_query`` has one row per query with ``num_results``."""
    m = per_query.agg(F.avg("num_results").alias("avg_results_per_query"), F.count(F.lit(1)).alias("total_queries"))
    return _verdict(m, "retrieval", issue_list([(F.col("avg_results_per_query") < minimum, "LOW_RETRIEVAL_COUNT")]))


def diagnose_context_window(checks: DataFrame) -> DataFrame:
    """``checks`` has one row per request with ``utilization`` and ``fits``."""
    m = checks.agg(
        F.avg("utilization").alias("avg_utilization"), F.max("utilization").alias("max_utilization"),
        F.count(F.when(~F.col("fits"), 1)).alias("overflow_count"),
    )
    issues = issue_list([
        (F.col("max_utilization") > 0.9, "CONTEXT_WINDOW_NEAR_LIMIT"),
        (F.col("avg_utilization") > 0.7, "HIGH_AVERAGE_UTILIZATION"),
        (F.col("overflow_count") > 0, F.concat(F.lit("CONTEXT_OVERFLOWS: "), F.col("overflow_count").cast("string"))),
    ])
    return _verdict(m, "context_window", issues)


def diagnosis_report(*parts: DataFrame) -> DataFrame:
    """All checks in one long table of (check, status, issues)."""
    out = None
    for part in parts:
        cut = part.select("check", "status", "issues")
        out = cut if out is None else out.unionByName(cut)
    return out


def audit_recent(audit: DataFrame, actions: Sequence[str], name_part: str, limit: int = 20) -> DataFrame:
    """Last day's audit events by action list or object name, newest first."""
    last = as_row(audit.agg(F.max("event_time").alias("t")))["t"]
    return (
        audit.where(F.col("event_time") >= last - F.expr("INTERVAL 1 DAY"))
        .where(F.col("action_name").isin(*actions) | F.contains(F.col("request_params.full_name_arg"), F.lit(name_part)))
        .orderBy(F.desc("event_time"), F.desc("event_id"))
        .limit(limit)
    )


def run_summary(log: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """Runs, successes, failures and mean time over successes, per group and overall."""
    ok = F.col("status") == "success"
    return log.rollup(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count(F.when(ok, 1)).alias("succeeded"),
        F.count(F.when(~ok, 1)).alias("failed"),
        F.avg(F.when(ok, F.col("latency_ms"))).alias("mean_time_ok"),
    )


def concurrency_profile(log: DataFrame, unit: str = "HOURS", slices: int | None = None) -> DataFrame:
    """Latency and throughput by the number of requests in flight when a request starts.

    A request is in flight from ``ts`` for ``latency_ms`` units. Starts and ends become +1 and -1, and the requests in flight
    are their running sum.
    """
    micros = {"MINUTES": 60_000_000, "HOURS": 3_600_000_000, "SECONDS": 1_000_000, "MILLISECONDS": 1_000}[unit]
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    end = start + F.round(F.col("latency_ms") * micros).cast("bigint")

    def step(at, by, starts):
        return F.struct(at.alias("at"), F.lit(by).cast("bigint").alias("in_flight"), F.lit(starts).alias("starts"), F.col("latency_ms"))

    steps = log.select(F.explode(F.array(step(start, 1, True), step(end, -1, False))).alias("p")).select("p.*")
    seen = running_sums(steps, [], ["at"], ["in_flight"], slices).where("starts")
    return seen.groupBy("in_flight").agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("latency_ms").alias("avg_latency"),
        F.min("latency_ms").alias("min_latency"),
        F.max("latency_ms").alias("max_latency"),
        (F.col("in_flight") / F.avg("latency_ms")).alias("throughput"),
    )


def stratified_baseline(log: DataFrame) -> DataFrame:
    return log.rollup("complexity", "category").agg(
        F.avg("latency_ms").alias("mean_latency"), F.avg("total_tokens").alias("mean_tokens"), F.count(F.lit(1)).alias("requests")
    )
