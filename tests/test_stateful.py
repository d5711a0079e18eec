"""State machines: hand cases, batch against a plain loop, and stream against batch."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import stateful as sf
from corpusloom.streaming import parts
from corpusloom.streaming import rollups as ru
from corpusloom.streaming import stateful as st
from corpusloom.sources.tables import table_stream
from corpusloom.streaming.index_sync import index_state, sync_index

S = sf.SECOND


def test_cooldown_case():
    c = sf.Cooldown()
    assert [c.step(t * S, 900 * S) for t in (0, 600, 900, 1500, 1800)] == ["FIRED", "SUPPRESSED", "FIRED", "SUPPRESSED", "FIRED"]


def test_limiter_counts_only_admitted():
    lim = sf.RateLimiter(max_requests=2, max_tokens=100)
    assert [lim.step(t * S, 10) for t in (0, 1, 2, 59, 60, 61)] == ["ALLOWED", "ALLOWED", "RATE_LIMIT_EXCEEDED", "RATE_LIMIT_EXCEEDED", "ALLOWED", "ALLOWED"]
    assert sf.RateLimiter(max_tokens=15).step(0, 16) == "TOKEN_LIMIT_EXCEEDED"


def test_breaker_cycle():
    b = sf.CircuitBreaker(recovery=60 * S)
    for t in range(8):
        assert b.step(t * S, 0) == "CALLED:CLOSED"
    assert b.step(8 * S, 1) == "CALLED:CLOSED"  # nine seen, below the minimum
    assert b.step(9 * S, 1) == "CALLED:OPEN"  # 2 of 10
    assert b.step(68 * S, 0) == "REJECTED:OPEN"
    assert b.step(69 * S, 1) == "CALLED:OPEN"  # half open, fails
    assert [b.step((129 + i) * S, 0) for i in range(3)] == ["CALLED:HALF_OPEN", "CALLED:HALF_OPEN", "CALLED:CLOSED"]
    assert b.step(140 * S, 1) == "CALLED:OPEN"  # the window was not cleared


def test_earlier_answers(spark):
    rows = [(i, "abacab"[i % 6] if i % 7 else None) for i in range(60)]
    got = sf.earlier_answers(spark.createDataFrame(rows, "id long, q string").repartition(4), "id", F.col("q")).collect()
    firsts = {}
    for i, q in rows:
        firsts.setdefault(q, i)
    # a null key is never an earlier answer
    assert {r.id: r.cache_result for r in got} == {i: "MISS" if q is not None and firsts[q] == i else "HIT" if q is not None else "MISS" for i, q in rows}


def test_cached_answers_evict_the_oldest_key(spark):
    rnd = random.Random(7)
    rows = [(i, None if i % 13 == 0 else f"q{rnd.randint(0, 9) if i % 3 else rnd.randint(0, 40)}") for i in range(900)]
    got = sf.cached_answers(spark.createDataFrame(rows, "id long, q string").repartition(6), "id", F.col("q"), 8).collect()
    cache, want = sf.FifoCache(size=8), {}
    for i, q in rows:
        want[i] = cache.step(i, q)
    # a key asked again after eight newer keys were stored is answered afresh
    assert {r.id: r.cache_result for r in got} == want and "HIT" in want.values()
    assert sum(v == "MISS" for v in want.values()) > len({q for _, q in rows})


@pytest.fixture(scope="module")
def log(spark):
    rnd = random.Random(4)
    rows, t = [], 0
    for i in range(600):
        t += rnd.choice([1, 5, 20, 400])
        rows.append((i, 0 if rnd.random() < 0.4 else rnd.randint(1, 5), t, rnd.randint(1, 40), int(rnd.random() < 0.3)))
    return rows, spark.createDataFrame(rows, "id long, user long, sec long, tokens long, failed int").withColumn("ts", F.timestamp_seconds("sec"))


LIMITS = dict(request_window=60 * S, token_window=600 * S, max_requests=3, max_tokens=120)


def loop(rows, machine, value):
    runs, out = {}, {}
    for i, user, sec, tokens, failed in rows:
        out[i] = runs.setdefault(user, machine()).step(sec * S, value(tokens, failed))
    return out


def test_batch_matches_loop(log):
    rows, df = log
    got = sf.rate_limit(df, "user", F.unix_micros("ts"), "id", F.col("tokens"), **LIMITS).collect()
    assert {r.id: r.rate_status for r in got} == loop(rows, lambda: sf.RateLimiter(**LIMITS), lambda tok, f: tok)
    got = sf.circuit_breaker(df, "user", F.unix_micros("ts"), "id", F.col("failed")).collect()
    assert {r.id: r.breaker for r in got} == loop(rows, sf.CircuitBreaker, lambda tok, f: f)


@pytest.mark.parametrize("rounds", [5, 1, 0])
@pytest.mark.parametrize("slices", [1, 7, 40])
def test_slices_of_busy_keys(spark, slices, rounds):
    """One key has most rows: its slices run apart, and the result is the loop's, however many rounds may settle them."""
    rnd = random.Random(slices)
    rows, t = [], 0
    for i in range(1500):
        t += rnd.choice([1, 2, 5, 30])
        rows.append((i, 7 if rnd.random() < 0.9 else rnd.choice([1, 9, None]), t, rnd.randint(1, 40), int(rnd.random() < 0.25)))
    df = spark.createDataFrame(rows, "id long, user long, sec long, tokens long, failed int").withColumn("ts", F.timestamp_seconds("sec")).repartition(5)
    clock = F.unix_micros("ts")
    cases = [
        (lambda s=None: sf.RateLimiter(s, **LIMITS), F.col("tokens"), lambda tok, f: tok, None),
        (lambda s=None: sf.CircuitBreaker(s), F.col("failed"), lambda tok, f: f, None),
        (lambda s=None: sf.Cooldown(s), F.lit(20 * S), lambda tok, f: 20 * S, 20 * S),
    ]
    for machine, value, plain, horizon in cases:
        got = sf.ordered_scan(df, "user", clock, "id", value, machine, "o", horizon, slices=slices, most_rounds=rounds)
        assert got.columns == [*df.columns, "o"]
        assert {r.id: r.o for r in got.collect()} == loop(rows, machine, plain) and got.count() == len(rows)


@pytest.mark.parametrize("kind", ["limiter", "breaker", "cooldown"])
def test_stream_matches_batch(spark, log, tmp_path, kind):
    rows, df = log
    for i in range(3):  # three files in time order, one per micro-batch
        df.where((F.col("id") >= 200 * i) & (F.col("id") < 200 * (i + 1))).coalesce(1).write.parquet(str(tmp_path / f"in/part={i}"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    clock = F.unix_micros("ts")
    value = {"limiter": F.col("tokens"), "breaker": F.col("failed"), "cooldown": F.lit(300 * S)}[kind]
    make = {
        "limiter": lambda s=None: sf.RateLimiter(s, **LIMITS), "breaker": lambda s=None: sf.CircuitBreaker(s),
        "cooldown": lambda s=None: sf.Cooldown(s),
    }[kind]
    horizon = {"limiter": 600 * S, "cooldown": 300 * S}.get(kind)
    want = {r.id: r.o for r in sf.ordered_scan(df, "user", clock, "id", value, make, "o", horizon).collect()}
    if horizon:
        stream = stream.withWatermark("ts", "1 day")
    out = st.stateful_stream(stream, "user", clock, "id", value, make, "o", horizon, "ts" if horizon else None)
    assert {r.id: r.o for r in st.run_available(out, kind).collect()} == want


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(900):
        us = None if i % 97 == 0 else rnd.randrange(0, 40 * 3600) * S + rnd.randrange(S)
        rows.append((i, rnd.choice([5, 5, 5, 1, 2, None]), us, rnd.choice(["error", "success"]), rnd.choice([None, 10, 20]), rnd.choice([None, 1.5, 2.5])))
    ddl = "request_id long, user_id long, us long, status string, total_tokens long, latency_ms double"
    return spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_micros("us"))


def feed(df, folder, orders):
    """Write the rows in as many files as there are orders, the batches of a stream that reads one file at a time."""
    for k, condition in enumerate(orders):
        df.where(condition).coalesce(1).write.mode("append").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


ORDERS = {
    "one file": ["TRUE"],
    "backwards": [f"us IS NULL AND {k} = 3 OR us BETWEEN {a} AND {a + 36_000 * S - 1}" for k, a in enumerate(range(108_000 * S, -1, -36_000 * S))],
    "mixed": [f"request_id % 6 = {k}" for k in (4, 0, 5, 2, 1, 3)],
}


@pytest.mark.parametrize("order", list(ORDERS))
def test_rollups_lose_nothing(spark, events, tmp_path, order):
    """Slots, sliding windows and sessions of a stream equal those of the table, in any order of files."""
    stream = feed(events, str(tmp_path / "in"), ORDERS[order])
    slots = ru.rollup_stream(stream, ru.traffic_rollup("ts", sf.HOUR), sf.HOUR, sf.HOUR, str(tmp_path / "t"), str(tmp_path / "c"), fan=2)
    timed = events.where("ts IS NOT NULL")
    by = lambda df: {r[0]: tuple(r)[1:] for r in df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert by(ru.tumbling_slots(slots, sf.HOUR)) == by(st.tumbling_metrics(timed, "ts", "1 hour"))
    assert by(ru.sliding_slots(slots, sf.HOUR, 3)) == by(st.sliding_counts(timed, "ts", "3 hours", "1 hour"))
    late = slots.agg(F.sum("late")).first()[0]
    assert (late == 0) == (order == "one file") and slots.where("closed").count() > 30 and slots.where("NOT closed").count() >= 1
    gap = 1800 * S
    stream = feed(events.select("user_id", "ts", "us", "request_id"), str(tmp_path / "in2"), ORDERS[order])
    slots = ru.rollup_stream(stream, ru.session_rollup("user_id", "ts", gap), gap, sf.HOUR, fan=3)
    want = timed.groupBy("user_id", F.session_window("ts", "30 minutes")).count()
    want = sorted((str(r.user_id), str(r.s), r["count"]) for r in want.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("s"), "count").collect())
    for got in (ru.sessions_of_slots(slots, gap), st.user_sessions(timed, "user_id", "ts", gap)):
        assert sorted((str(r.user_id), str(r.session_start), r.requests) for r in got.collect()) == want


def test_a_repeated_batch_counts_once(spark, events, tmp_path):
    rollup = ru.traffic_rollup("ts", sf.HOUR)
    write = ru.merge_into(rollup, str(tmp_path), sf.HOUR, 0, fan=2)
    for k in (0, 1, 2, 2, 3, 3, 4):
        write(events.where(f"request_id % 5 = {k}"), k)
    assert ru.rollup_table(spark, rollup, str(tmp_path), sf.HOUR, 0).agg(F.sum("n")).first()[0] == events.where("ts IS NOT NULL").count()
    found = parts.finished_parts(spark, str(tmp_path))
    assert len(parts.cover(found)) <= 2 and parts.drop_covered(spark, str(tmp_path)) == len(found) - len(parts.cover(found))
    assert ru.rollup_table(spark, rollup, str(tmp_path), sf.HOUR, 0).agg(F.sum("n")).first()[0] == events.where("ts IS NOT NULL").count()


def test_parts():
    assert parts.cover([(0, 0), (1, 1), (0, 1), (2, 2), (3, 3)]) == [(0, 1), (2, 2), (3, 3)]
    assert parts.cover([(0, 0), (1, 1), (0, 3), (2, 2), (3, 3)], before=3) == [(0, 0), (1, 1), (2, 2)]


@pytest.mark.parametrize("order", list(ORDERS))
def test_log_table(spark, events, tmp_path, order):
    """Each request arrives twice, in other batches too, late or not: it is logged once."""
    twice = [*ORDERS[order], *ORDERS["mixed"][:2]]
    got = st.log_table(feed(events, str(tmp_path / "in"), twice), "ts", "request_id", str(tmp_path / "log"))
    assert got.columns == events.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, events.where(" OR ".join(f"({c})" for c in twice)).collect()))


def test_index_sync_in_batches(spark, tmp_path):
    ddl = "doc_id long, content string"
    first = spark.createDataFrame([(1, "One text here. " * 40), (2, "Two.")], ddl)
    second = spark.createDataFrame([(2, "Two changed text."), (1, "One text here. " * 40), (3, "Three is new here.")], ddl)
    src, path, ck = str(tmp_path / "src"), str(tmp_path / "ix"), str(tmp_path / "ck")
    stream = lambda: spark.readStream.schema(first.schema).parquet(src)
    first.coalesce(1).write.parquet(src)
    sync_index(stream(), path, ck)
    second.coalesce(1).write.mode("append").parquet(src)
    got = sync_index(stream(), path, ck).groupBy("doc_id").agg(F.max("batch_id").alias("b"), F.count(F.lit(1)).alias("n"), F.min("content").alias("c")).collect()
    got = {r.doc_id: r for r in got}
    assert got[1].b == 0 and got[1].n == 2  # unchanged, not embedded again
    assert got[2].b == 1 and got[2].c == "Two changed text." and got[2].n == 1
    assert got[3].b == 1
    assert index_state(spark, str(tmp_path / "none")).count() == 0


def test_index_sync_versions_and_deletes(spark, tmp_path):
    ddl = "doc_id long, content string, version long"
    batches = [[(1, "One.", 1), (2, "Two.", 1), (3, "Three.", 1)], [(1, "One, older.", 2), (1, "One, newest.", 3), (2, "Two, for a moment.", 2), (2, None, 3), (3, "", 2), (4, None, 1)], [(2, "Two is back.", 4)]]
    src, path, ck = str(tmp_path / "src"), str(tmp_path / "ix"), str(tmp_path / "ck")
    want = [{1: "One.", 2: "Two.", 3: "Three."}, {1: "One, newest.", 3: ""}, {1: "One, newest.", 2: "Two is back.", 3: ""}]  # an empty text is one empty chunk
    for rows, index in zip(batches, want):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(src)
        got = sync_index(spark.readStream.schema(ddl).parquet(src), path, ck, "version").collect()
        assert {r.doc_id: r.content for r in got} == index and len(got) == len(index)


def test_index_sync_batches_are_bounded(spark, tmp_path):
    from corpusloom.operators.chunking import ARROW_BYTES, BATCH_BYTES
    from corpusloom.streaming.index_sync import merge_batch

    ddl = "doc_id long, content string"
    src, path = str(tmp_path / "src"), str(tmp_path / "ix")
    spark.createDataFrame([(1, "One text here. " * 40), (2, "Two.")], ddl).coalesce(1).write.parquet(src)
    held, seen = spark.conf.get(ARROW_BYTES), []
    merge = merge_batch(path)

    def run(batch, batch_id):
        batch.sparkSession.conf.set(ARROW_BYTES, str(256 << 20))  # as a stream's session holds it before any chunking
        merge(batch, batch_id)
        seen.append(int(batch.sparkSession.conf.get(ARROW_BYTES)))

    try:
        q = spark.readStream.schema(ddl).parquet(src).writeStream.foreachBatch(run).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(ARROW_BYTES, held)
    # the chunker runs in the batch's own session, so the bound must be set there
    assert seen and all(b <= BATCH_BYTES for b in seen)
    assert sorted(r.doc_id for r in index_state(spark, path).select("doc_id").distinct().collect()) == [1, 2]


def test_stream_of_a_folder_table(spark, tmp_path):
    rows = spark.range(50).select(F.col("id").alias("item_id"), F.lit("some text").alias("text"))
    rows.repartition(3).write.parquet(str(tmp_path / "benchmark.parquet"))
    rows.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    out = st.run_available(table_stream(spark, str(tmp_path), "benchmark"), "folder-table")
    assert out.count() == 50
