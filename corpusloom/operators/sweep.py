"""Running sums along a time line, for lines of any length.

The events are range partitioned by (key, order) and written once, so that a busy key lies in several slices of about equal size.
A slice's total is one small row; the totals before a slice enter it as one more event at its start. So every slice is
summed on its own, in one pass, and work grows with the number of events, not with how many a window holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialise


def running_sums(events: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str], slices: int | None = None) -> DataFrame:
    """The events with their ``sums`` replaced by the sums of all events of the key up to and with those of equal order."""
    placed = events.repartitionByRange(*([slices] if slices else []), *keys, *order).withColumn("_slice", F.spark_partition_id())
    placed = materialise(placed, "sweep")
    totals = placed.groupBy(*keys, "_slice").agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_slice", *[F.sum(c).over(before).alias(c) for c in sums], F.lit(0).alias("_event"))
    carried = carried.where(reduce(or_, [F.col(c) != 0 for c in sums]))
    both = placed.withColumn("_event", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    upto = Window.partitionBy(*keys, "_slice").orderBy("_event", *order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = {c: F.sum(c).over(upto) for c in sums}
    return both.select(*[run[c].alias(c) if c in run else F.col(c) for c in both.columns]).where("_event = 1").drop("_event", "_slice")
