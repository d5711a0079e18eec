"""Windowed aggregates of a stream that lose nothing: partial sums per window as a table.

A micro-batch is reduced to one row a key and time slot, on the map side first, and written as a part. Sums, minima and maxima
of slots can be merged in any order, so a row that comes late, in whatever file, adds to its window like any other, and the
newest windows are there without waiting for later rows to close them. No state store grows with the stream: parts
are merged as they pile up. Tumbling windows are the slots; sliding windows and sessions are put together from slots, never
from rows, so a busy user or minute is a few slots in each task.

Whether a window can still change is told by the clock: the newest event so far less the allowed delay. Rows that came when
their slot was already closed are counted as late.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import scratch_path
from corpusloom.streaming.parts import FAN, merge_parts, read_parts, write_part

MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Rollup:
    """Keys and measures of a table of partial aggregates. A measure is (how to merge, type, aggregate of rows)."""

    keys: dict[str, tuple[str, Column]]
    measures: dict[str, tuple[str, str, Column]]

    @property
    def ddl(self) -> str:
        return ", ".join([*(f"{k} {t}" for k, (t, _) in self.keys.items()), *(f"{m} {t}" for m, (_, t, _) in self.measures.items())])

    def partials(self, rows: DataFrame) -> DataFrame:
        keyed = rows.select("*", *[c.cast(t).alias(f"_{k}") for k, (t, c) in self.keys.items()])
        aggregates = [c.cast(t).alias(m) for m, (_, t, c) in self.measures.items()]
        return keyed.groupBy(*[F.col(f"_{k}").alias(k) for k in self.keys]).agg(*aggregates)

    def merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.keys).agg(*[MERGES[how](m).cast(t).alias(m) for m, (how, t, _) in self.measures.items()])


def slot_of(event_time: str, width: int) -> Column:
    """Number of the slot of ``width`` microseconds that holds the event."""
    return F.floor(F.unix_micros(F.col(event_time).cast("timestamp")) / F.lit(width)).cast("bigint")


def slot_rollup(event_time: str, width: int, measures: dict[str, tuple[str, str, Column]], keys: dict[str, tuple[str, Column]] | None = None) -> Rollup:
    """A rollup by time slot (and further keys) with the first and last event of each slot."""
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    own = {"first_us": ("min", "bigint", F.min(at)), "last_us": ("max", "bigint", F.max(at))}
    return Rollup({**(keys or {}), "slot": ("bigint", slot_of(event_time, width))}, own | measures)


def with_late(rollup: Rollup) -> Rollup:
    return Rollup(rollup.keys, {**rollup.measures, "late": ("sum", "bigint", F.sum("late"))})


def merge_into(rollup: Rollup, path: str, width: int, delay: int, fan: int = FAN):
    """A ``foreachBatch`` function that adds a micro-batch to the table at ``path`` and counts its late rows."""
    table = with_late(rollup)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = read_parts(spark, path, table.ddl, before=batch_id).agg(F.max("last_us")).first()[0]  # one number
        closed = F.lit(False) if newest is None else (F.col("slot") + 1) * width <= F.lit(newest - delay)
        rows = rollup.partials(batch).where("slot IS NOT NULL")
        rows = rows.withColumn("late", F.when(closed, F.lit(1)).otherwise(F.lit(0)).cast("bigint") * F.col("n"))
        write_part(rows, path, batch_id)
        merge_parts(spark, path, batch_id, table.ddl, table.merged, fan)

    return write


def rollup_stream(stream: DataFrame, rollup: Rollup, width: int, delay: int, path: str | None = None, checkpoint: str | None = None, fan: int = FAN) -> DataFrame:
    """Process all available input and return the merged slots with ``late`` and ``closed``."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, "rollup")
    checkpoint = checkpoint or scratch_path(spark, "rollup-checkpoint")
    q = stream.writeStream.foreachBatch(merge_into(rollup, path, width, delay, fan)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return rollup_table(spark, rollup, path, width, delay)


def rollup_table(spark: SparkSession, rollup: Rollup, path: str, width: int, delay: int) -> DataFrame:
    """The slots of the table at ``path``; ``closed`` tells that the clock has passed a slot by the delay."""
    table = with_late(rollup)
    slots = table.merged(read_parts(spark, path, table.ddl))
    clock = slots.agg(F.max("last_us") - F.lit(delay)).scalar()
    return slots.withColumn("closed", (F.col("slot") + 1) * width <= clock)


def slot_start(width: int) -> Column:
    return F.timestamp_micros(F.col("slot") * width).cast("timestamp_ntz").alias("window_start")


def traffic_rollup(event_time: str, width: int) -> Rollup:
    """Requests, errors, tokens and latency of the traffic log by slot."""
    return slot_rollup(event_time, width, {
        "n": ("sum", "bigint", F.count(F.lit(1))), "errors": ("sum", "bigint", F.count(F.when(F.col("status") == "error", 1))),
        "tokens": ("sum", "bigint", F.sum("total_tokens")), "latency": ("sum", "double", F.sum("latency_ms")), "timed": ("sum", "bigint", F.count("latency_ms")),
    })


def tumbling_slots(slots: DataFrame, width: int) -> DataFrame:
    return slots.select(slot_start(width), F.col("n").alias("requests"), (F.col("latency") / F.nullif(F.col("timed"), F.lit(0))).alias("avg_latency"), "errors")


def sliding_slots(slots: DataFrame, slide: int, count: int) -> DataFrame:
    """Windows of ``count`` slots, one starting at each slot that any of its rows can fall into."""
    spread = slots.withColumn("slot", F.explode(F.sequence(F.col("slot") - (count - 1), F.col("slot"))))
    return spread.groupBy("slot").agg(F.sum("n").alias("requests"), F.sum("tokens").alias("tokens")).select(slot_start(slide), "requests", "tokens")


def session_rollup(user: str, event_time: str, gap: int) -> Rollup:
    """First and last event and number of rows by user and slot of the gap's width."""
    return slot_rollup(event_time, gap, {"n": ("sum", "bigint", F.count(F.lit(1)))}, {"user_id": ("bigint", F.col(user))})


def sessions_of_slots(slots: DataFrame, gap: int) -> DataFrame:
    """Sessions from slots of the gap's width: rows of one slot are always one session, so only slots are compared.

    A task gets one row for each slot in which a user was active, never the rows of the user.
    """
    order = Window.partitionBy("user_id").orderBy("slot")
    before = F.lag("last_us").over(order)
    opens = F.when(before.isNull() | (F.col("first_us") - before >= gap), 1).otherwise(0)
    numbered = slots.withColumn("_new", opens).withColumn("_session", F.sum("_new").over(order))
    out = numbered.groupBy("user_id", "_session").agg(F.min("first_us").alias("first_us"), F.sum("n").alias("requests"))
    return out.select("user_id", F.timestamp_micros("first_us").cast("timestamp_ntz").alias("session_start"), "requests")
