"""Presence by day: how many stays of a group cover each day.

Sweep line: a stay adds one on its first day and takes one off after its last.  The
changes of a (group, day) are summed on every task first, so what moves is at most a
row per group and day, whatever the number of stays.  Presence is their running sum,
taken on two levels: within a month, and over the months before it, so no window holds
more than the days of a month or the months of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.clean import q


def presence_by_day(stays: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """(group, day, present) for every day from a group's first change to its last;
    ``start`` and ``end`` are dates and both days count.

    Stays without a start or an end, or that end before they start, are not counted.
    A null group is a group.
    """
    known = stays.where(q(start) <= q(end))
    steps = F.array(F.struct(q(start).alias("day"), F.lit(1).alias("change")),
                    F.struct(F.date_add(q(end), 1).alias("day"), F.lit(-1).alias("change")))
    changes = (known.select(q(group).alias("_group"), F.explode(steps).alias("step"))
               .groupBy("_group", "step.day").agg(F.sum("step.change").alias("change")))
    # Days without a change are days, too.
    every = (changes.groupBy("_group").agg(F.min("day").alias("first"), F.max("day").alias("last"))
             .select("_group", F.explode(F.sequence("first", "last")).alias("day"),
                     F.lit(0).cast("long").alias("change")))
    daily = (changes.unionByName(every).groupBy("_group", F.trunc("day", "month").alias("month"), "day")
             .agg(F.sum("change").alias("change")))
    before = (Window.partitionBy("_group").orderBy("month")
              .rowsBetween(Window.unboundedPreceding, -1))
    months = (daily.groupBy(F.col("_group").alias("_g"), F.col("month").alias("_m"))
              .agg(F.sum("change").alias("_change"))
              .withColumnsRenamed({"_g": "_group", "_m": "month"})
              .withColumn("_offset", F.coalesce(F.sum("_change").over(before), F.lit(0)))
              .withColumnsRenamed({"_group": "_g", "month": "_m"}).drop("_change"))
    upto = (Window.partitionBy("_group", "month").orderBy("day")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = daily.withColumn("_running", F.sum("change").over(upto))
    return (running.join(months, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("month") == F.col("_m")))
            .select(F.col("_group").alias(group), "day",
                    (F.col("_running") + F.col("_offset")).alias("present")))
