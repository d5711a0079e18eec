"""Operators whose next decision depends on earlier ones: rate limiter, circuit breaker and alert cooldown; and re-use of
earlier answers.

Each is a small state machine over one key's rows in time order. ``ordered_scan`` runs it in batch,
``streaming.stateful`` runs the same machine on a stream.

In batch a key is not one task. The rows are range partitioned by (key, time), so a busy key is cut into time slices. All
slices run at once, each from a fresh machine, and report the state they end in. Where a slice should have started from its
predecessor's end state instead, it alone runs again from that state; where the machine has forgotten its start by the
end of a slice, the chain is settled after one such round. Where it has not (a key that is always at its limit), the slices left
run in a row. Rows stream through a task in order and
only the machine's state is held.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.monitoring import COOLDOWN_SECONDS
from corpusloom.session import materialise

SECOND = 1_000_000
MINUTE, HOUR = 60 * SECOND, 3600 * SECOND


class RateLimiter:
    """Admits a request unless the admitted ones of the last window reach a limit. Rejects leave no trace."""

    state_ddl = "times array<bigint>, tokens array<bigint>"

    def __init__(self, state=None, request_window=MINUTE, token_window=HOUR, max_requests=10, max_tokens=100_000):
        self.admitted = deque(zip(*state)) if state else deque()
        self.request_window, self.token_window = request_window, token_window
        self.max_requests, self.max_tokens = max_requests, max_tokens
        self.horizon = max(request_window, token_window)

    def step(self, now: int, tokens: int) -> str:
        while self.admitted and self.admitted[0][0] <= now - self.horizon:
            self.admitted.popleft()
        if sum(t > now - self.request_window for t, _ in self.admitted) >= self.max_requests:
            return "RATE_LIMIT_EXCEEDED"
        if sum(n for t, n in self.admitted if t > now - self.token_window) + tokens > self.max_tokens:
            return "TOKEN_LIMIT_EXCEEDED"
        self.admitted.append((now, tokens))
        return "ALLOWED"

    def settled(self, now: int, horizon: int | None = None):
        """The state as far as rows from ``now`` on can tell it from another."""
        held = [(t, n) for t, n in self.admitted if t > now - self.horizon]
        return [int(t) for t, _ in held], [int(n) for _, n in held]

    def dump(self):
        return [int(t) for t, _ in self.admitted], [int(n) for _, n in self.admitted]


class CircuitBreaker:
    """CLOSED opens when the failure rate of the last outcomes passes a threshold, checked on failures.
    OPEN rejects until a time-out. HALF_OPEN closes after some successes and reopens on one failure."""

    state_ddl = "state string, successes int, retry_at bigint, outcomes array<int>"

    def __init__(self, state=None, threshold=0.2, recovery=60 * SECOND, successes_to_close=3, window=50, minimum=10):
        name, won, retry_at, outcomes = state or ("CLOSED", 0, 0, [])
        self.state, self.successes, self.retry_at = name, won, retry_at
        self.outcomes = deque(outcomes, maxlen=window)
        self.threshold, self.recovery, self.successes_to_close, self.minimum = threshold, recovery, successes_to_close, minimum

    def _open(self, now: int) -> None:
        self.state, self.retry_at = "OPEN", now + self.recovery

    def step(self, now: int, failed: int) -> str:
        if self.state == "OPEN":
            if now < self.retry_at:
                return "REJECTED:OPEN"
            self.state, self.successes = "HALF_OPEN", 0
        self.outcomes.append(int(failed))
        if self.state == "HALF_OPEN":
            if failed:
                self._open(now)
            else:
                self.successes += 1
                if self.successes >= self.successes_to_close:
                    self.state = "CLOSED"
        elif failed and len(self.outcomes) >= self.minimum and sum(self.outcomes) / len(self.outcomes) >= self.threshold:
            self._open(now)
        return f"CALLED:{self.state}"

    def settled(self, now: int, horizon: int | None = None):
        successes = int(self.successes) if self.state == "HALF_OPEN" else 0
        return self.state, successes, int(self.retry_at) if self.state == "OPEN" else 0, list(self.outcomes)

    def dump(self):
        return self.state, int(self.successes), int(self.retry_at), list(self.outcomes)


class Cooldown:
    """Fires an alert unless the same rule fired less than its cooldown ago; suppressed ones do not count."""

    state_ddl = "last_fired bigint"

    def __init__(self, state=None):
        self.last = state[0] if state else None

    def step(self, now: int, cooldown: int) -> str:
        if self.last is not None and now - self.last < cooldown:
            return "SUPPRESSED"
        self.last = now
        return "FIRED"

    def settled(self, now: int, horizon: int | None = None):
        """With ``horizon`` (the longest cooldown) an alert that long ago is forgotten."""
        return (None if self.last is None or horizon is not None and now - self.last >= horizon else int(self.last),)

    def dump(self):
        return (None if self.last is None else int(self.last),)


class FifoCache:
    """Answers a key from the cache when it holds it, else answers afresh and stores the key, the oldest one leaving a full
    cache. Hits do not refresh a key; a null key is answered afresh and not stored."""

    state_ddl = "held array<string>"

    def __init__(self, state=None, size=50):
        self.held, self.size = deque(state[0] if state else ()), size
        self.keys = set(self.held)

    def step(self, now: int, key) -> str:
        if key is None or key != key:
            return "MISS"
        if key in self.keys:
            return "HIT"
        if len(self.held) >= self.size:
            self.keys.discard(self.held.popleft())
        self.held.append(key)
        self.keys.add(key)
        return "MISS"

    def settled(self, now: int, horizon: int | None = None):
        return (list(self.held),)

    def dump(self):
        return (list(self.held),)


def _scan(machine, key: str, columns: list[str], out: str, slice_of: str, entries: dict[int, str] | None):
    """Runs the machine over sorted rows; after the rows of a slice comes one row with its first and last key, first time and
    end state. ``entries`` are the states from which the first key of each slice starts (a fresh machine without)."""

    def start(number):
        return machine(json.loads(entries[number])) if entries and number in entries else machine()

    def ending(number, first, last, began, run):
        state = json.dumps({"first": first, "last": last, "clock": began, "end": json.dumps(run.dump())})
        return pd.DataFrame({**{c: [None] for c in columns}, out: [None], "_clock": [None], "_value": [None], "_slice": [number], "_first": [None], "_state": [state]})

    def plain(x):
        return None if x is None or x != x else x.item() if hasattr(x, "item") else x

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = first = last = began = run = None
        for pdf in batches:
            cut, results, firsts = 0, [], []
            for i, (number, k, now, val) in enumerate(zip(pdf[slice_of], pdf[key], pdf["_clock"], pdf["_value"])):
                k = plain(k)
                if number != at:
                    if at is not None:
                        yield frame(pdf, cut, i, results, firsts)
                        yield ending(at, first, last, began, run)
                        cut, results, firsts = i, [], []
                    at, first, last, began, run = int(number), k, k, int(now), start(int(number))
                elif k != last:
                    last, run = k, machine()
                results.append(run.step(now, val))
                firsts.append(k == first)
            yield frame(pdf, cut, len(pdf), results, firsts)
        if at is not None:
            yield ending(at, first, last, began, run)

    def frame(pdf, a, b, results, firsts):
        part = pdf.iloc[a:b]
        return part[columns].assign(**{out: pd.Series(results, index=part.index, dtype=object), "_clock": part["_clock"], "_value": part["_value"],
                                       "_slice": part[slice_of], "_first": pd.Series(firsts, index=part.index, dtype=object), "_state": None})

    return scan


def ordered_scan(
    df: DataFrame, key: str, clock: Column, tie: str, value: Column, machine: Callable[..., object], out: str, horizon: int | None = None,
    slices: int | None = None, most_rounds: int = 2,
) -> DataFrame:
    """Adds column ``out``: the machine's result for each row, per key in (clock, tie) order.

    ``slices`` is the number of time slices (the number of shuffle partitions by default). What the driver gets is one state
    a slice and round. Slices that are not settled after ``most_rounds`` run in a row, each busy stretch in one task.
    """
    columns = df.columns
    rows = df.select("*", clock.alias("_clock"), value.alias("_value"))
    placed = rows.repartitionByRange(*([slices] if slices else []), key, "_clock", tie).sortWithinPartitions(key, "_clock", tie)
    placed = placed.withColumn("_slice", F.spark_partition_id())
    ddl = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"`{out}` string", *(f"{c} {t}" for c, t in rows.dtypes[-2:]), "_slice int, _first boolean, _state string"])
    done = [materialise(placed.mapInPandas(_scan(machine, key, columns, out, "_slice", None), ddl), "scan-slices")]
    ends = {r["_slice"]: json.loads(r["_state"]) for r in done[0].where("_state IS NOT NULL").select("_slice", "_state").collect()}
    order = sorted(ends)
    settle = lambda state, now: json.dumps(machine(state).settled(now, horizon))
    entry = {p: settle(None, ends[p]["clock"]) for p in order}
    latest = dict.fromkeys(order, 0)
    for turn in range(1, most_rounds + 2):
        asked = {}
        for p, q in zip(order, order[1:]):
            if ends[p]["last"] == ends[q]["first"]:
                state = settle(json.loads(ends[p]["end"]), ends[q]["clock"])
                if state != entry[q]:
                    asked[q] = state
        if not asked:
            break
        leader = {q: q for q in asked}
        if turn > most_rounds:  # run what is left in a row: each slice joins the first unsettled one of its stretch
            for p, q in zip(order, order[1:]):
                if p in leader and ends[p]["first"] == ends[p]["last"] == ends[q]["first"]:
                    leader[q] = leader[p]
        groups = F.create_map(*[F.lit(x) for pair in leader.items() for x in pair])[F.col("_slice")]
        again = union_of([done[t].where(F.col("_slice").isin([q for q in leader if latest[q] == t])) for t in sorted({latest[q] for q in leader})])
        again = again.where("_state IS NULL AND _first").withColumn("_group", groups)
        again = again.repartitionByRange(max(1, len(set(leader.values()))), "_group").sortWithinPartitions("_group", "_clock", tie)
        if turn > most_rounds:
            # the slices of a stretch are told apart no longer, and no state is needed any more
            done.append(materialise(again.mapInPandas(_scan(machine, key, columns, out, "_group", asked), ddl), "scan-slices"))
            latest.update({q: turn for q in set(leader.values())})
            for q in leader:
                if leader[q] != q:
                    latest[q] = None
            break
        done.append(materialise(again.mapInPandas(_scan(machine, key, columns, out, "_group", asked), ddl), "scan-slices"))
        for r in done[turn].where("_state IS NOT NULL").select("_slice", "_state").collect():
            q = r["_slice"]
            entry[q], latest[q] = asked[q], turn
            if ends[q]["first"] == ends[q]["last"]:
                ends[q]["end"] = json.loads(r["_state"])["end"]
    rest = [q for q in order if latest[q] != 0]
    parts = [done[0].where("_state IS NULL").where(~F.col("_slice").isin(rest) | ~F.col("_first"))]
    parts += [done[t].where("_state IS NULL").where(F.col("_slice").isin([q for q in rest if latest[q] == t])) for t in range(1, len(done))]
    return union_of(parts).select(*columns, out)


def union_of(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def cached_answers(requests: DataFrame, id_col: str, key: Column, size: int = 50) -> DataFrame:
    """Adds ``cache_key`` and ``cache_result`` of one cache of ``size`` keys that sees all requests in id order."""
    keyed = requests.withColumn("cache_key", key).withColumn("_cache", F.lit(0))
    out = ordered_scan(keyed, "_cache", F.col(id_col), id_col, F.col("cache_key"), lambda state=None: FifoCache(state, size), "cache_result")
    return out.drop("_cache")


def rate_limit(log: DataFrame, user: str, clock: Column, tie: str, tokens: Column, **limits) -> DataFrame:
    return ordered_scan(log, user, clock, tie, tokens, lambda state=None: RateLimiter(state, **limits), "rate_status", RateLimiter(**limits).horizon)


def circuit_breaker(log: DataFrame, endpoint: str, clock: Column, tie: str, failed: Column, **params) -> DataFrame:
    return ordered_scan(log, endpoint, clock, tie, failed.cast("int"), lambda state=None: CircuitBreaker(state, **params), "breaker")


def cooldown_column(severity: str, seconds=COOLDOWN_SECONDS) -> Column:
    c = F.lit(None).cast("bigint")
    for name, s in seconds.items():
        c = F.when(F.col(severity) == name, F.lit(int(s) * SECOND)).otherwise(c)
    return c


def alert_cooldown(alerts: DataFrame, rule: str, clock: Column, severity: str, seconds=COOLDOWN_SECONDS) -> DataFrame:
    horizon = int(max(seconds.values())) * SECOND
    return ordered_scan(alerts, rule, clock, severity, cooldown_column(severity, seconds), Cooldown, "outcome", horizon)


def earlier_answers(requests: DataFrame, id_col: str, key: Column) -> DataFrame:
    """Adds ``cache_key`` and ``cache_result``: MISS for the first request of a key by id, HIT for later ones.

    The first ids come from a map-side minimum, and a row is matched to them by (id, key), so that a key with a third of all
    requests is no group of its own. A null key is always a MISS.
    """
    keyed = requests.withColumn("cache_key", key)
    first = keyed.groupBy("cache_key").agg(F.min(id_col).alias(id_col)).withColumn("_first", F.lit(True))
    result = F.when(F.col("_first") | F.col("cache_key").isNull(), "MISS").otherwise("HIT").alias("cache_result")
    return keyed.join(first, [id_col, "cache_key"], "left").select(*keyed.columns, result)
