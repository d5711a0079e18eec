"""Stateful and streaming queries over the traffic log and the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import stateful as sf
from corpusloom.operators.answers import reuse_key
from corpusloom.plans.corpus_queries import GREEDY_CTE
from corpusloom.plans.monitoring_queries import WINDOW_ALERTS_CTE, window_alerts
from corpusloom.plans.registry import query
from corpusloom.plans.retrieval_queries import _KEY
from corpusloom.plans.shared import r6, rounded
from corpusloom.session import materialise, scratch_path
from corpusloom.sources.bindings import docs, traffic, traffic_columns
from corpusloom.sources.tables import table, table_stream
from corpusloom.streaming import rollups as ru
from corpusloom.streaming import stateful as st
from corpusloom.streaming.index_sync import sync_index

V = ("v_traffic",)


def clock(column: str = "ts"):
    return F.unix_micros(F.col(column).cast("timestamp"))


# A user of the data sends about two requests a day.
LIMITS = dict(request_window=6 * sf.HOUR, token_window=24 * sf.HOUR, max_requests=2, max_tokens=300)

LIMITER_SQL = f"""WITH o AS (SELECT request_id, user_id, epoch_us(ts) AS us, total_tokens AS tok, row_number() OVER (PARTITION BY user_id ORDER BY ts, request_id) AS rn FROM v_traffic),
r(user_id, rn, request_id, adm, rate_status) AS (
  SELECT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS STRUCT(us BIGINT, tok BIGINT)[]), '' FROM o WHERE rn = 1
  UNION ALL SELECT user_id, rn, request_id, CASE WHEN s = 'ALLOWED' THEN list_append(kept, {{'us': us, 'tok': tok}}) ELSE kept END, s FROM (
    SELECT *, CASE WHEN len(list_filter(kept, lambda x: x.us > us - {6 * sf.HOUR})) >= 2 THEN 'RATE_LIMIT_EXCEEDED'
      WHEN coalesce(list_sum(list_transform(kept, lambda x: x.tok)), 0) + tok > 300 THEN 'TOKEN_LIMIT_EXCEEDED' ELSE 'ALLOWED' END AS s FROM (
      SELECT o.user_id, o.rn, o.request_id, o.us, o.tok, list_filter(r.adm, lambda x: x.us > o.us - {24 * sf.HOUR}) AS kept
      FROM r JOIN o ON o.user_id = r.user_id AND o.rn = r.rn + 1)))
SELECT request_id, user_id, rate_status FROM r WHERE rn > 0"""


@query("rate_limiter", LIMITER_SQL, V, recursive=True)
def _(spark, root):
    log = traffic(spark, root).select("request_id", "user_id", "ts", "total_tokens")
    return sf.rate_limit(log, "user_id", clock(), "request_id", F.col("total_tokens"), **LIMITS).select("request_id", "user_id", "rate_status")


def log_stream(spark, root):
    """The traffic log as a stream with a session-zone event time."""
    return traffic_columns(table_stream(spark, root, "events")).withColumn("ts", F.col("ts").cast("timestamp"))


@query("rate_limiter_stream", LIMITER_SQL, V, recursive=True)
def _(spark, root):
    log = log_stream(spark, root).select("request_id", "user_id", "ts", "total_tokens").withWatermark("ts", "1 hour")
    out = st.stateful_stream(
        log, "user_id", F.unix_micros("ts"), "request_id", F.col("total_tokens"), lambda s=None: sf.RateLimiter(s, **LIMITS), "rate_status",
        horizon=24 * sf.HOUR, event_time="ts",
    )
    return st.run_available(out, "rate-limiter").select("request_id", "user_id", "rate_status")


DAY = 24 * sf.HOUR


BREAKER_SQL = f"""WITH o AS (SELECT request_id, user_id, epoch_us(ts) AS us, CAST(status = 'error' AS INT) AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, request_id) AS rn FROM v_traffic),
r(user_id, rn, request_id, st, succ, nxt, win, breaker) AS (
  SELECT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), 'CLOSED', 0, CAST(0 AS BIGINT), CAST([] AS INT[]), '' FROM o WHERE rn = 1
  UNION ALL SELECT user_id, rn, request_id, s1, CASE WHEN s0 = 'HALF_OPEN' AND f = 0 THEN c0 + 1 ELSE c0 END,
    CASE WHEN s0 <> 'OPEN' AND s1 = 'OPEN' THEN us + {DAY} ELSE nxt END, w1, CASE WHEN s0 = 'OPEN' THEN 'REJECTED:OPEN' ELSE 'CALLED:' || s1 END FROM (
    SELECT *, CASE WHEN s0 = 'OPEN' THEN 'OPEN' WHEN s0 = 'HALF_OPEN' AND f = 1 THEN 'OPEN' WHEN s0 = 'HALF_OPEN' AND c0 + 1 >= 3 THEN 'CLOSED' WHEN s0 = 'HALF_OPEN' THEN s0
      WHEN f = 1 AND len(w1) >= 10 AND list_sum(w1) / CAST(len(w1) AS DOUBLE) >= CAST(0.2 AS DOUBLE) THEN 'OPEN' ELSE 'CLOSED' END AS s1 FROM (
      SELECT *, CASE WHEN s0 = 'OPEN' THEN win WHEN len(win) >= 50 THEN list_append(win[2:], f) ELSE list_append(win, f) END AS w1 FROM (
        SELECT o.user_id, o.rn, o.request_id, o.us, o.f, r.nxt, r.win, CASE WHEN r.st = 'OPEN' AND o.us >= r.nxt THEN 'HALF_OPEN' ELSE r.st END AS s0,
          CASE WHEN r.st = 'OPEN' AND o.us >= r.nxt THEN 0 ELSE r.succ END AS c0 FROM r JOIN o ON o.user_id = r.user_id AND o.rn = r.rn + 1))))
SELECT request_id, user_id, breaker FROM r WHERE rn > 0"""


@query("circuit_breaker", BREAKER_SQL, V, recursive=True)
def _(spark, root):
    log = traffic(spark, root).select("request_id", "user_id", "ts", "status")
    return sf.circuit_breaker(log, "user_id", clock(), "request_id", F.col("status") == "error", recovery=DAY).select("request_id", "user_id", "breaker")


@query("circuit_breaker_stream", BREAKER_SQL, V, recursive=True)
def _(spark, root):
    log = log_stream(spark, root).select("request_id", "user_id", "ts", "status")
    failed = (F.col("status") == "error").cast("int")
    out = st.stateful_stream(log, "user_id", F.unix_micros("ts"), "request_id", failed, lambda s=None: sf.CircuitBreaker(s, recovery=DAY), "breaker")
    return st.run_available(out, "circuit-breaker").select("request_id", "user_id", "breaker")


# Windows are one hour, so the cooldowns are scaled to hours.
COOL = {"critical": 3 * 3600, "warning": 6 * 3600}


COOLDOWN_SQL = f"""WITH {WINDOW_ALERTS_CTE},
o AS (SELECT window_start, rule, severity, epoch_us(window_start) AS us, row_number() OVER (PARTITION BY rule ORDER BY window_start) AS rn,
  CASE severity WHEN 'critical' THEN {COOL['critical'] * sf.SECOND} ELSE {COOL['warning'] * sf.SECOND} END AS cd FROM al),
r(rule, rn, window_start, severity, fired, outcome) AS (
  SELECT rule, CAST(0 AS BIGINT), CAST(NULL AS TIMESTAMP), '', CAST(NULL AS BIGINT), '' FROM o WHERE rn = 1
  UNION ALL SELECT o.rule, o.rn, o.window_start, o.severity, CASE WHEN r.fired IS NULL OR o.us - r.fired >= o.cd THEN o.us ELSE r.fired END,
    CASE WHEN r.fired IS NULL OR o.us - r.fired >= o.cd THEN 'FIRED' ELSE 'SUPPRESSED' END FROM r JOIN o ON o.rule = r.rule AND o.rn = r.rn + 1)
SELECT window_start, rule, severity, outcome FROM r WHERE rn > 0"""


@query("alert_cooldown", COOLDOWN_SQL, V, recursive=True)
def _(spark, root):
    alerts = materialise(window_alerts(traffic(spark, root)).drop("message"), "alerts")
    return sf.alert_cooldown(alerts, "rule", clock("window_start"), "severity", COOL)


@query("alert_cooldown_stream", COOLDOWN_SQL, V, recursive=True)
def _(spark, root):
    """The alerts as a stream of their own, with the cooldown of each rule in its state."""
    alerts, path = window_alerts(traffic(spark, root)).drop("message"), scratch_path(spark, "alerts")
    alerts.write.parquet(path)
    stream = spark.readStream.schema(alerts.schema).parquet(path)
    out = st.stateful_stream(stream, "rule", clock("window_start"), "severity", sf.cooldown_column("severity", COOL), lambda s=None: sf.Cooldown(s), "outcome")
    return st.run_available(out, "alert-cooldown").select("window_start", "rule", "severity", "outcome")


# The reference's cached pipeline: one cache of 50 keys for all requests, the oldest key leaving a full cache.
CACHE_SIZE = 50


@query("response_cache", f"""WITH o AS (SELECT doc_id, {_KEY} AS k, row_number() OVER (ORDER BY doc_id) AS rn FROM v_docs),
r(rn, doc_id, k, held, cache_result) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST([] AS VARCHAR[]), ''
  UNION ALL SELECT o.rn, o.doc_id, o.k, CASE WHEN o.k IS NULL OR list_contains(r.held, o.k) THEN r.held WHEN len(r.held) >= {CACHE_SIZE} THEN list_append(r.held[2:], o.k) ELSE list_append(r.held, o.k) END,
    CASE WHEN o.k IS NOT NULL AND list_contains(r.held, o.k) THEN 'HIT' ELSE 'MISS' END FROM r JOIN o ON o.rn = r.rn + 1)
SELECT doc_id, k AS cache_key, cache_result FROM r WHERE rn > 0""", ("v_docs",), recursive=True)
def _(spark, root):
    d = docs(spark, root).select("doc_id", reuse_key(F.col("content")).alias("k"))
    return sf.cached_answers(d, "doc_id", F.col("k"), CACHE_SIZE).select("doc_id", "cache_key", "cache_result")


@query("log_sink_stream", f"""SELECT count(*) AS total_requests, {r6('avg(latency_ms)')} AS avg_latency_ms, max(latency_ms) AS max_latency_ms, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  {r6("count(*) FILTER (status = 'success') * 100.0 / count(*)")} AS success_rate FROM v_traffic""", V)
def _(spark, root):
    # Every row arrives twice.
    twice = log_stream(spark, root).unionByName(log_stream(spark, root))
    return rounded(st.log_summary(st.log_table(twice, "ts", "request_id")))


@query("index_sync_stream", f"WITH {GREEDY_CTE} SELECT doc_id, chunk_index, md5(content) AS digest, char_count > 10 AS has_vector FROM chunks", ("v_docs",), recursive=True)
def _(spark, root):
    stream = table_stream(spark, root, "documents").select("doc_id", F.col("text").alias("content"))
    return sync_index(stream).select("doc_id", "chunk_index", F.md5("content").alias("digest"), F.col("embedding").isNotNull().alias("has_vector"))


CHANGED = "doc_id IN (SELECT doc_id FROM labels WHERE quality = 0 AND toxic = 0)"
TOXIC = "doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"


def change_log(spark, root):
    """Three steps of changes (doc_id, content, version): all documents; junk cut to its first line, toxic ones changed and
    removed in one step; English toxic ones brought back with their title."""
    d = docs(spark, root).select("doc_id", "content", "title", "category")
    marks = table(spark, root, "labels").select("doc_id", "quality", "toxic")
    junk = d.join(marks.where("quality = 0 AND toxic = 0"), "doc_id", "left_semi")
    toxic = d.join(marks.where("toxic = 1"), "doc_id", "left_semi")
    row = lambda rows, content, version: rows.select("doc_id", content.cast("string").alias("content"), F.lit(version).alias("version"))
    title = F.col("title")
    return [
        row(d, F.col("content"), 1),
        row(junk, title, 2).union(row(toxic, F.concat(F.lit("For a moment. "), title), 2)).union(row(toxic, F.lit(None), 3)),
        row(toxic.where("category = 'en'"), title, 4),
    ]


@query("index_maintenance_stream", f"""WITH v_docs AS (SELECT doc_id, lang AS category, split_part(text, chr(10), 1) AS title,
  CASE WHEN {CHANGED} OR {TOXIC} THEN split_part(text, chr(10), 1) ELSE text END AS content FROM documents WHERE NOT {TOXIC} OR lang = 'en'),
{GREEDY_CTE} SELECT doc_id, chunk_index, md5(content) AS digest FROM chunks""", recursive=True)
def _(spark, root):
    source, index, checkpoint = (scratch_path(spark, x) for x in ("changes", "index", "index-checkpoint"))
    for step in change_log(spark, root):
        step.write.mode("append").parquet(source)
        out = sync_index(spark.readStream.schema(step.schema).parquet(source), index, checkpoint, "version")
    return out.select("doc_id", "chunk_index", F.md5("content").alias("digest"))


TUMBLE = f"SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, {r6('avg(latency_ms)')} AS avg_latency, count(*) FILTER (status = 'error') AS errors FROM v_traffic"


@query("tumbling_windows", f"{TUMBLE} GROUP BY 1", V)
def _(spark, root):
    return rounded(st.tumbling_metrics(traffic(spark, root), "ts", "1 hour"))


def hourly_slots(spark, root):
    """The hourly slots of the traffic stream; an hour's delay tells open from closed ones."""
    log = log_stream(spark, root).select("ts", "status", "total_tokens", "latency_ms")
    return ru.rollup_stream(log, ru.traffic_rollup("ts", sf.HOUR), sf.HOUR, sf.HOUR)


@query("tumbling_windows_stream", f"{TUMBLE} GROUP BY 1", V)
def _(spark, root):
    return rounded(ru.tumbling_slots(hourly_slots(spark, root), sf.HOUR))


@query("open_windows_stream", "SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM v_traffic) - INTERVAL 1 HOUR AS closed FROM v_traffic GROUP BY 1", V)
def _(spark, root):
    return hourly_slots(spark, root).select(ru.slot_start(sf.HOUR), F.col("n").alias("requests"), "closed")


SLIDE = """SELECT date_trunc('hour', ts) - i * INTERVAL 1 HOUR AS window_start, count(*) AS requests, CAST(sum(total_tokens) AS BIGINT) AS tokens
  FROM v_traffic, range(6) t(i) GROUP BY 1"""


@query("sliding_windows", SLIDE, V)
def _(spark, root):
    return st.sliding_counts(traffic(spark, root), "ts", "6 hours", "1 hour")


@query("sliding_windows_stream", SLIDE, V)
def _(spark, root):
    return ru.sliding_slots(hourly_slots(spark, root), sf.HOUR, 6)


SESSIONS = """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS n FROM v_traffic WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS requests FROM s GROUP BY user_id, s"""


@query("user_sessions", SESSIONS, V)
def _(spark, root):
    return st.user_sessions(traffic(spark, root), "user_id", "ts", 6 * sf.HOUR)


@query("user_sessions_stream", SESSIONS, V)
def _(spark, root):
    log = log_stream(spark, root).select("user_id", "ts")
    slots = ru.rollup_stream(log, ru.session_rollup("user_id", "ts", 6 * sf.HOUR), 6 * sf.HOUR, sf.HOUR)
    return ru.sessions_of_slots(slots, 6 * sf.HOUR)
