"""Monitoring queries over the traffic log."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import monitoring as mo
from corpusloom.plans.registry import query
from corpusloom.plans.shared import r6, rounded
from corpusloom.sources.bindings import traffic
from corpusloom.sources.tables import spread, table

V = ("v_traffic",)
# The log holds 30 days, which the reviews compare by halves.
HALF = "2024-01-16"
SLOW = {"simple": 50.0, "moderate": 100.0, "complex": 150.0}
STAGES = ["embedding", "search", "formatting", "generation"]


def _metric_sql(hours: str = "168") -> str:
    return f"""
  {r6("quantile_cont(latency_ms, 0.5)")} AS latency_p50, {r6("quantile_cont(latency_ms, 0.95)")} AS latency_p95,
  {r6("quantile_cont(latency_ms, 0.99)")} AS latency_p99, {r6("avg(latency_ms)")} AS latency_mean,
  {r6("stddev(latency_ms)")} AS latency_std, count(*) AS total_requests,
  {r6(f"count(*) / CAST({hours} AS DOUBLE)")} AS requests_per_hour,
  {r6("avg(CASE WHEN status = 'success' THEN 1 ELSE 0 END)")} AS success_rate,
  {r6("avg(CASE WHEN status = 'error' THEN 1 ELSE 0 END)")} AS error_rate,
  {r6("avg(input_tokens)")} AS avg_input_tokens, {r6("avg(output_tokens)")} AS avg_output_tokens,
  {r6("avg(total_tokens)")} AS avg_total_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens_consumed,
  {r6("avg(quality_score)")} AS avg_quality_score,
  {r6("avg(CASE WHEN quality_score < CAST(0.7 AS DOUBLE) THEN 1 ELSE 0 END)")} AS quality_below_threshold,
  {r6("avg(CASE WHEN complexity = 'simple' THEN 1 ELSE 0 END)")} AS pct_simple,
  {r6("avg(CASE WHEN complexity = 'moderate' THEN 1 ELSE 0 END)")} AS pct_moderate,
  {r6("avg(CASE WHEN complexity = 'complex' THEN 1 ELSE 0 END)")} AS pct_complex"""


THRESHOLDS_CTE = """th AS (
  SELECT avg(latency_ms) AS latency_mean, stddev(latency_ms) AS latency_std,
         quantile_cont(latency_ms, 0.95) AS latency_p95, quantile_cont(latency_ms, 0.99) AS latency_p99,
         quantile_cont(latency_ms, 0.25) - 1.5 * (quantile_cont(latency_ms, 0.75) - quantile_cont(latency_ms, 0.25)) AS latency_iqr_low,
         quantile_cont(latency_ms, 0.75) + 1.5 * (quantile_cont(latency_ms, 0.75) - quantile_cont(latency_ms, 0.25)) AS latency_iqr_high,
         avg(total_tokens) AS tokens_mean, stddev(total_tokens) AS tokens_std,
         quantile_cont(CAST(total_tokens AS DOUBLE), 0.95) AS tokens_p95, quantile_cont(CAST(total_tokens AS DOUBLE), 0.99) AS tokens_p99,
         avg(CASE WHEN status = 'error' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS error_baseline,
         greatest(CAST(0.05 AS DOUBLE), 2 * avg(CASE WHEN status = 'error' THEN CAST(1 AS DOUBLE) ELSE 0 END)) AS error_threshold
  FROM {src})"""


@query("traffic_metrics", f"SELECT {_metric_sql()} FROM v_traffic", V)
def _(spark, root):
    return rounded(mo.traffic_metrics(traffic(spark, root)))


@query("latency_by_category", f"""SELECT category, {r6("quantile_cont(latency_ms, 0.5)")} AS median_latency,
  {r6("quantile_cont(latency_ms, 0.95)")} AS p95_latency, {r6("avg(latency_ms)")} AS mean_latency
  FROM v_traffic GROUP BY category""", V)
def _(spark, root):
    return rounded(mo.latency_by(traffic(spark, root), "category"))


@query("latency_by_hour", f"""SELECT CAST(hour(ts) AS INT) AS hour_of_day, {r6("avg(latency_ms)")} AS mean_latency,
  count(*) AS requests FROM v_traffic GROUP BY 1""", V)
def _(spark, root):
    return rounded(mo.hourly_profile(traffic(spark, root)))


@query("slow_queries", """SELECT complexity, category, count(*) AS requests,
  count(*) FILTER (latency_ms > CASE complexity WHEN 'simple' THEN 50 WHEN 'moderate' THEN 100 WHEN 'complex' THEN 150 ELSE 1000 END) AS slow
  FROM v_traffic GROUP BY ALL""", V)
def _(spark, root):
    return mo.flag_slow(traffic(spark, root), SLOW).groupBy("complexity", "category").agg(
        F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("is_slow"), 1)).alias("slow")
    )


@query("latency_outliers", """SELECT request_id, category, complexity, latency_ms FROM v_traffic
  WHERE latency_ms > (SELECT avg(latency_ms) + 3 * stddev(latency_ms) FROM v_traffic)""", V)
def _(spark, root):
    return mo.sigma_outliers(traffic(spark, root)).select("request_id", "category", "complexity", "latency_ms")


_TH_COLS = ("latency_mean latency_std latency_p95 latency_p99 latency_iqr_low latency_iqr_high tokens_mean tokens_std "
            "tokens_p95 tokens_p99 error_baseline error_threshold").split()


@query("baseline_thresholds",
       "WITH " + THRESHOLDS_CTE.format(src="v_traffic")
       + " SELECT " + ", ".join(f"{r6(c)} AS {c}" for c in _TH_COLS) + " FROM th", V)
def _(spark, root):
    return rounded(mo.baseline_thresholds(traffic(spark, root)))


ANOMALY_CTE = THRESHOLDS_CTE.format(src="v_traffic") + """,
an AS (
  SELECT 'latency_zscore' AS kind, request_id, latency_ms AS value, (latency_ms - latency_mean) / latency_std AS score
  FROM v_traffic, th WHERE abs((latency_ms - latency_mean) / latency_std) > 3
  UNION ALL SELECT 'latency_percentile', request_id, latency_ms, latency_ms / latency_p99 FROM v_traffic, th WHERE latency_ms > latency_p99
  UNION ALL SELECT 'latency_iqr', request_id, latency_ms, latency_ms / latency_iqr_high FROM v_traffic, th WHERE latency_ms > latency_iqr_high
  UNION ALL SELECT 'token_zscore', request_id, CAST(total_tokens AS DOUBLE), (total_tokens - tokens_mean) / tokens_std
  FROM v_traffic, th WHERE abs((total_tokens - tokens_mean) / tokens_std) > 2)"""


@query("anomalies", f"WITH {ANOMALY_CTE} SELECT kind, request_id, {r6('value')} AS value, {r6('score')} AS score FROM an", V)
def _(spark, root):
    log = traffic(spark, root)
    return rounded(mo.anomalies(log, mo.baseline_thresholds(log)))


@query("top_anomalies", f"""WITH {ANOMALY_CTE} SELECT kind, request_id, {r6('value')} AS value, {r6('score')} AS score FROM an
  WHERE kind IN ('latency_zscore', 'token_zscore')
  QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(score, 6) DESC, request_id) <= 5""", V)
def _(spark, root):
    log = traffic(spark, root)
    return rounded(mo.top_anomalies(mo.anomalies(log, mo.baseline_thresholds(log)), ["latency_zscore", "token_zscore"]))


@query("error_rate_check", f"""WITH {THRESHOLDS_CTE.format(src="v_traffic")}
  SELECT {r6("c")} AS current_error_rate, {r6("error_threshold")} AS error_threshold, c > error_threshold AS is_anomaly
  FROM (SELECT avg(CASE WHEN status = 'error' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS c FROM v_traffic), th""", V)
def _(spark, root):
    log = traffic(spark, root)
    return rounded(mo.error_rate_check(log, mo.baseline_thresholds(log)))


def _alert_sql(metrics: str, keep: str = "") -> str:
    rules = [
        ("latency_critical", "m.latency_p99 > th.latency_p99 * 2"),
        ("latency_warning", "m.latency_p95 > th.latency_p95 * 1.5"),
        ("error_rate_critical", "m.error_rate > CAST(0.10 AS DOUBLE)"),
        ("error_rate_warning", "m.error_rate > CAST(0.05 AS DOUBLE)"),
        ("token_spike", "m.avg_total_tokens > th.tokens_p95"),
        ("quality_degradation", "coalesce(m.avg_quality_score, 1) < CAST(0.7 AS DOUBLE)"),
    ]
    meta = {r: (s, m) for r, s, m in mo.ALERT_RULES}
    return "\nUNION ALL ".join(
        f"SELECT {keep} '{r}' AS rule, '{meta[r][0]}' AS severity, '{meta[r][1]}' AS message FROM {metrics} m, th WHERE {c}"
        for r, c in rules
    )


_RAW_METRICS = """quantile_cont(latency_ms, 0.5) AS latency_p50, quantile_cont(latency_ms, 0.95) AS latency_p95,
  quantile_cont(latency_ms, 0.99) AS latency_p99, avg(total_tokens) AS avg_total_tokens, avg(quality_score) AS avg_quality_score,
  avg(CASE WHEN status = 'error' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS error_rate"""


@query("alert_rules", f"""WITH {THRESHOLDS_CTE.format(src="v_traffic")}, mt AS (SELECT {_RAW_METRICS} FROM v_traffic)
  {_alert_sql("mt")}""", V)
def _(spark, root):
    log = traffic(spark, root)
    return mo.evaluate_alerts(mo.traffic_metrics(log), mo.baseline_thresholds(log))


@query("windowed_metrics", f"SELECT date_trunc('hour', ts) AS window_start, {_metric_sql('1')} FROM v_traffic GROUP BY 1", V)
def _(spark, root):
    return rounded(mo.windowed_metrics(traffic(spark, root)))


WINDOW_ALERTS_CTE = f"""{THRESHOLDS_CTE.format(src="v_traffic")},
mw AS (SELECT date_trunc('hour', ts) AS window_start, {_RAW_METRICS} FROM v_traffic GROUP BY 1),
al AS ({_alert_sql("mw", "window_start,")})"""


@query("windowed_alerts", f"WITH {WINDOW_ALERTS_CTE} SELECT window_start, rule, severity FROM al", V)
def _(spark, root):
    return window_alerts(traffic(spark, root)).drop("message")


def window_alerts(log):
    return mo.evaluate_alerts(mo.windowed_metrics(log), mo.baseline_thresholds(log), keep=["window_start"])


@query("token_usage", """
  SELECT CASE WHEN grouping(complexity) = 0 THEN 'complexity' ELSE 'category' END AS dimension,
         CASE WHEN grouping(complexity) = 0 THEN complexity ELSE category END AS member,
         round(avg(input_tokens), 2) AS input_mean, round(avg(output_tokens), 2) AS output_mean, round(avg(total_tokens), 2) AS total_mean,
         CAST(sum(total_tokens) AS BIGINT) AS total_sum, count(*) AS requests
  FROM v_traffic GROUP BY GROUPING SETS ((complexity), (category))""", V)
def _(spark, root):
    return mo.token_usage(traffic(spark, root))


@query("token_cost", f"""WITH c AS (SELECT quantile_cont(CAST(total_tokens AS DOUBLE), 0.9) AS cut FROM v_traffic)
  SELECT {r6("any_value(cut)")} AS high_threshold, count(*) FILTER (total_tokens > cut) AS high_requests,
         {r6("avg(CASE WHEN total_tokens > cut THEN CAST(1 AS DOUBLE) ELSE 0 END) * 100")} AS high_request_pct,
         {r6("coalesce(sum(total_tokens) FILTER (total_tokens > cut), 0) / sum(total_tokens) * 100")} AS high_token_pct,
         {r6("sum(input_tokens) / 1000 * 0.0015::DOUBLE + sum(output_tokens) / 1000 * 0.002::DOUBLE")} AS total_cost,
         count(*) AS requests
  FROM v_traffic, c""", V)
def _(spark, root):
    return rounded(mo.token_cost(traffic(spark, root)))


def halves(log):
    cut = F.lit(HALF).cast("timestamp_ntz")
    return log.where(F.col("ts") < cut), log.where(F.col("ts") >= cut)


@query("period_review", f"""WITH {THRESHOLDS_CTE.format(src=f"(SELECT * FROM v_traffic WHERE ts < TIMESTAMP '{HALF}')")},
b AS (SELECT {_RAW_METRICS} FROM v_traffic WHERE ts < TIMESTAMP '{HALF}'),
c AS (SELECT {_RAW_METRICS} FROM v_traffic WHERE ts >= TIMESTAMP '{HALF}'),
al AS ({_alert_sql("c")}),
m AS (SELECT 'latency_p50' AS metric, b.latency_p50 AS baseline, c.latency_p50 AS current FROM b, c
  UNION ALL SELECT 'latency_p95', b.latency_p95, c.latency_p95 FROM b, c
  UNION ALL SELECT 'avg_total_tokens', b.avg_total_tokens, c.avg_total_tokens FROM b, c
  UNION ALL SELECT 'error_rate', b.error_rate, c.error_rate FROM b, c),
d AS (SELECT *, CASE WHEN baseline > 0 THEN (current - baseline) / baseline * 100 ELSE 0 END AS change_pct FROM m),
s AS (SELECT *, CASE WHEN abs(change_pct) < 20 THEN 'OK' WHEN change_pct > 0 THEN 'DEGRADED' ELSE 'IMPROVED' END AS status FROM d)
SELECT metric, {r6("baseline")} AS baseline, {r6("current")} AS current, {r6("change_pct")} AS change_pct, status,
  CASE WHEN status = 'DEGRADED' THEN CASE metric WHEN 'latency_p95' THEN 'HIGH' WHEN 'avg_total_tokens' THEN 'MEDIUM' WHEN 'error_rate' THEN 'HIGH' END END AS priority,
  CASE WHEN status = 'DEGRADED' THEN CASE metric WHEN 'latency_p95' THEN 'Latency' WHEN 'avg_total_tokens' THEN 'Cost' WHEN 'error_rate' THEN 'Reliability' END END AS area,
  CASE WHEN (SELECT count(*) FROM al) > 0 THEN 'NEEDS_ATTENTION' ELSE 'HEALTHY' END AS health,
  (SELECT count(*) FROM al WHERE severity = 'critical') AS critical_alerts
FROM s""", V)
def _(spark, root):
    old, new = halves(traffic(spark, root))
    base, cur = mo.traffic_metrics(old), mo.traffic_metrics(new)
    return rounded(mo.period_review(cur, base, mo.evaluate_alerts(cur, mo.baseline_thresholds(old))))


@query("spike_analysis", f"""WITH p AS (SELECT quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
  quantile_cont(latency_ms, 0.99) AS p99 FROM v_traffic),
m AS (SELECT any_value(p50) AS p50, any_value(p95) AS p95, any_value(p99) AS p99, max(latency_ms) AS max_latency,
  count(*) FILTER (latency_ms > 2 * p50) * CAST(100 AS DOUBLE) / count(*) AS spike_rate, var_pop(latency_ms) AS latency_variance FROM v_traffic, p),
q AS (SELECT *, greatest(CAST(0 AS DOUBLE), (p95 - p50) * CAST(0.3 AS DOUBLE)) AS queue_wait FROM m)
SELECT {r6("p50")} AS p50, {r6("p95")} AS p95, {r6("p99")} AS p99, {r6("max_latency")} AS max_latency, {r6("spike_rate")} AS spike_rate,
  {r6("latency_variance")} AS latency_variance, {r6("queue_wait")} AS queue_wait,
  100 - CASE WHEN spike_rate > 10 THEN 20 ELSE 0 END - CASE WHEN queue_wait > 0.5 THEN 20 ELSE 0 END AS health_score FROM q""", V)
def _(spark, root):
    return rounded(mo.spike_analysis(traffic(spark, root)))


def stages(spark, root):
    """Stage times of a request, taken from the amounts of an order line."""
    return spread(table(spark, root, "lineitem"), "l_orderkey").select(
        F.col("l_quantity").alias("embedding"), (F.col("l_discount") * 1000).alias("search"),
        (F.col("l_tax") * 100).alias("formatting"), (F.col("l_extendedprice") / 100).alias("generation"),
    )


@query("stage_profile", f"""WITH w AS (SELECT l_quantity AS embedding, l_discount * 1000 AS search, l_tax * 100 AS formatting,
  l_extendedprice / 100 AS generation FROM lineitem),
l AS (SELECT 'embedding' AS stage, embedding AS s FROM w UNION ALL SELECT 'search', search FROM w
  UNION ALL SELECT 'formatting', formatting FROM w UNION ALL SELECT 'generation', generation FROM w
  UNION ALL SELECT 'total', embedding + search + formatting + generation FROM w),
g AS (SELECT stage, avg(s) AS mean_s, quantile_cont(s, 0.5) AS p50_s, quantile_cont(s, 0.95) AS p95_s, sum(s) AS sum_s FROM l GROUP BY stage)
SELECT stage, {r6("mean_s")} AS mean_s, {r6("p50_s")} AS p50_s, {r6("p95_s")} AS p95_s,
  {r6("sum_s / (SELECT sum_s FROM g WHERE stage = 'total') * 100")} AS share_pct,
  stage = (SELECT arg_max(stage, sum_s) FROM g WHERE stage <> 'total') AS is_bottleneck FROM g""")
def _(spark, root):
    return rounded(mo.stage_profile(stages(spark, root), STAGES))


@query("service_dashboard", f"""SELECT {r6("quantile_cont(latency_ms, 0.5)")} AS p50_latency, {r6("quantile_cont(latency_ms, 0.95)")} AS p95_latency,
  {r6("quantile_cont(latency_ms, 0.99)")} AS p99_latency, count(*) AS total_requests,
  {r6("avg(CASE WHEN status = 'success' THEN 1 ELSE 0 END) * 100")} AS success_pct, {r6("avg(latency_ms)")} AS avg_latency,
  {r6("max(latency_ms)")} AS max_latency, count(*) FILTER (status = 'error') AS error_count, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  {r6("count(*) / greatest(CAST(1 AS DOUBLE), (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(60000000 AS DOUBLE))")} AS requests_per_minute
  FROM v_traffic""", V)
def _(spark, root):
    return rounded(mo.service_dashboard(traffic(spark, root)))


@query("nearest_rank_p95", """WITH o AS (SELECT category, latency_ms, row_number() OVER (PARTITION BY category ORDER BY latency_ms) AS rn,
  count(*) OVER (PARTITION BY category) AS n FROM v_traffic)
  SELECT category, latency_ms AS p95_nearest FROM o
  WHERE rn = CASE WHEN n >= 20 THEN CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1 ELSE n END""", V)
def _(spark, root):
    return mo.nearest_rank_p95(traffic(spark, root), ["category"])


DIAG_LATENCY_CTE = """o AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms) AS rn, count(*) OVER () AS n FROM v_traffic),
d AS (SELECT avg(latency_ms) AS avg_latency_ms, max(latency_ms) AS max_latency_ms,
  max(CASE WHEN rn = CASE WHEN n >= 20 THEN CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1 ELSE n END THEN latency_ms END) AS p95_latency_ms FROM o),
lat AS (SELECT *, concat_ws(', ', CASE WHEN max_latency_ms > avg_latency_ms * 3 THEN 'LATENCY_SPIKE_DETECTED' END,
  CASE WHEN p95_latency_ms > 50 THEN 'P95_EXCEEDS_SLA' END, CASE WHEN avg_latency_ms > 25 THEN 'HIGH_AVERAGE_LATENCY' END) AS issues FROM d)"""
# The data's latencies lie near 20, so the limits are scaled from 2000 and 1000.
SLA, HIGH = 50.0, 25.0


@query("latency_diagnosis", f"""WITH {DIAG_LATENCY_CTE}
  SELECT {r6("avg_latency_ms")} AS avg_latency_ms, {r6("max_latency_ms")} AS max_latency_ms, {r6("p95_latency_ms")} AS p95_latency_ms,
  'latency' AS check, issues, CASE WHEN issues = '' THEN 'HEALTHY' ELSE 'ISSUES_FOUND' END AS status FROM lat""", V)
def _(spark, root):
    return rounded(mo.diagnose_latency(traffic(spark, root), SLA, HIGH))


@query("audit_recent", """SELECT event_id, ts AS event_time, 'user' || user_id || '@example.com' AS email, event_type AS action_name,
  'catalog.schema.object_' || json_extract_string(props, '$.k') AS object_name, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code
  FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
    AND (event_type IN ('signup', 'purchase') OR contains('catalog.schema.object_' || json_extract_string(props, '$.k'), 'object_7'))
  ORDER BY ts DESC, event_id DESC LIMIT 20""")
def _(spark, root):
    return mo.audit_recent(audit(spark, root), ["signup", "purchase"], "object_7").select(
        "event_id", "event_time", F.col("user_identity.email").alias("email"), "action_name",
        F.col("request_params.full_name_arg").alias("object_name"), F.col("response.status_code").alias("status_code"),
    )


def audit(spark, root):
    """Audit events with nested identity, request and response."""
    k = F.from_json("props", "k int")["k"]
    return table(spark, root, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email")).alias("user_identity"),
        F.col("event_type").alias("action_name"),
        F.struct(F.concat(F.lit("catalog.schema.object_"), k.cast("string")).alias("full_name_arg")).alias("request_params"),
        F.struct(F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code")).alias("response"),
    )


@query("audit_by_action", """SELECT event_type AS action_name, count(*) AS events, count(DISTINCT user_id) AS users, max(ts) AS last_seen
  FROM events WHERE event_type LIKE '%ur%' OR event_type = 'error' GROUP BY 1""")
def _(spark, root):
    a = audit(spark, root)
    return (
        a.where(F.col("action_name").like("%ur%") | (F.col("action_name") == "error"))
        .groupBy("action_name")
        .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_identity.email").alias("users"), F.max("event_time").alias("last_seen"))
    )


@query("run_summary", f"""SELECT category, count(*) AS runs, count(*) FILTER (status = 'success') AS succeeded,
  count(*) FILTER (status <> 'success') AS failed, {r6("avg(latency_ms) FILTER (status = 'success')")} AS mean_time_ok
  FROM v_traffic GROUP BY ROLLUP (category)""", V)
def _(spark, root):
    return rounded(mo.run_summary(traffic(spark, root)))


@query("concurrency_profile", f"""WITH p AS (
  SELECT epoch_us(ts) AS inst, CAST(1 AS BIGINT) AS delta FROM v_traffic
  UNION ALL SELECT epoch_us(ts) + CAST(round(latency_ms * 60000000) AS BIGINT), -1 FROM v_traffic),
s AS (SELECT inst, sum(delta) AS delta FROM p GROUP BY inst),
l AS (SELECT inst, CAST(sum(delta) OVER (ORDER BY inst) AS BIGINT) AS in_flight FROM s)
SELECT in_flight, count(*) AS requests, {r6("avg(latency_ms)")} AS avg_latency, {r6("min(latency_ms)")} AS min_latency,
  {r6("max(latency_ms)")} AS max_latency, {r6("in_flight / avg(latency_ms)")} AS throughput
FROM (SELECT epoch_us(ts) AS inst, latency_ms FROM v_traffic) JOIN l USING (inst) GROUP BY in_flight""", V)
def _(spark, root):
    return rounded(mo.concurrency_profile(traffic(spark, root), unit="MINUTES"))


@query("stratified_baseline", f"""SELECT complexity, category, {r6("avg(latency_ms)")} AS mean_latency, {r6("avg(total_tokens)")} AS mean_tokens,
  count(*) AS requests FROM v_traffic GROUP BY ROLLUP (complexity, category)""", V)
def _(spark, root):
    return rounded(mo.stratified_baseline(traffic(spark, root)))
