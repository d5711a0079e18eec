"""The state machines on streams, and stream execution helpers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from corpusloom.session import scratch_path
from corpusloom.streaming.parts import part_path, read_parts
from corpusloom.streaming.rollups import session_rollup, sessions_of_slots


def stateful_stream(
    stream: DataFrame, key: str, clock: Column, tie: str, value: Column, machine: Callable[..., object], out: str,
    horizon: int | None = None, event_time: str | None = None,
) -> DataFrame:
    """Adds ``out`` to a stream. Rows of a micro-batch run in (clock, tie) order.

    With ``horizon`` and a watermarked ``event_time`` a key's state is dropped once the watermark is past its
    last row by the horizon. Rows older than the watermark are dropped; other late rows are judged against the
    state at their arrival.
    """
    rows = stream.withColumn("_clock", clock).withColumn("_value", value)
    columns = stream.columns
    expire = horizon is not None and event_time is not None

    def advance(group_key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        run = machine(state.get if state.exists else None)
        last = 0
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(["_clock", tie], kind="stable")
        results = [run.step(now, val) for now, val in zip(pdf["_clock"], pdf["_value"])]
        last = int(pdf["_clock"].max())
        state.update(run.dump())
        if expire:
            state.setTimeoutTimestamp(max((last + horizon) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pdf[columns].assign(**{out: results})

    ddl = ", ".join(f"`{c}` {t}" for c, t in stream.dtypes)
    timeout = GroupStateTimeout.EventTimeTimeout if expire else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(advance, f"{ddl}, `{out}` string", machine().state_ddl, "append", timeout)


def run_available(stream: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Process all available input into a Parquet table and return its reader."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def store_log(path: str, ddl: str, event_time: str, key: str):
    """A ``foreachBatch`` function that appends the rows of a batch whose key is not in the log yet.

    The log is partitioned by day. A repeated request carries its own time, so only the keys of the batch's days are read,
    and rows that come late, or in files of any order, are kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.dropDuplicates([key]).withColumn("_day", F.to_date(event_time))
        days = [r[0] for r in rows.select("_day").distinct().collect()]  # the days of one batch
        known = read_parts(batch.sparkSession, path, f"{ddl}, _day date", before=batch_id)
        known = known.where(F.col("_day").isin([d for d in days if d is not None]) | (F.col("_day").isNull() if None in days else F.lit(False)))
        new = rows.join(known.select(key), key, "left_anti")
        new.select(*rows.columns).write.mode("overwrite").partitionBy("_day").parquet(part_path(path, batch_id, batch_id))

    return write


def log_table(stream: DataFrame, event_time: str, key: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all available input into a log without repeated keys and return its reader."""
    spark = stream.sparkSession
    path, checkpoint = path or scratch_path(spark, "log"), checkpoint or scratch_path(spark, "log-checkpoint")
    ddl = ", ".join(f"`{c}` {t}" for c, t in stream.dtypes)
    q = stream.writeStream.foreachBatch(store_log(path, ddl, event_time, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return read_parts(spark, path, f"{ddl}, _day date").drop("_day")


def log_summary(log: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return log.agg(
        n.alias("total_requests"), F.avg("latency_ms").alias("avg_latency_ms"), F.max("latency_ms").alias("max_latency_ms"),
        F.sum("total_tokens").alias("total_tokens"), (F.count(F.when(F.col("status") == "success", 1)) * F.lit(100.0) / n).alias("success_rate"),
    )


def tumbling_metrics(log: DataFrame, event_time: str, width: str) -> DataFrame:
    """Counts per window of a stored log; ``rollups`` has the form for streams."""
    return log.groupBy(F.window(event_time, width)).agg(
        F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("avg_latency"), F.count(F.when(F.col("status") == "error", 1)).alias("errors")
    ).select(F.col("window.start").alias("window_start"), "requests", "avg_latency", "errors")


def sliding_counts(log: DataFrame, event_time: str, width: str, slide: str) -> DataFrame:
    return log.groupBy(F.window(event_time, width, slide)).agg(F.count(F.lit(1)).alias("requests"), F.sum("total_tokens").alias("tokens")).select(
        F.col("window.start").alias("window_start"), "requests", "tokens"
    )


def user_sessions(log: DataFrame, user: str, event_time: str, gap: int) -> DataFrame:
    """Sessions of a stored log, put together from slots of ``gap`` microseconds that are reduced before the shuffle."""
    rollup = session_rollup(user, event_time, gap)
    return sessions_of_slots(rollup.partials(log).where("slot IS NOT NULL"), gap)
