"""As-of join: each row meets the last reading of its key at or before its time.

A window over a key would gather all rows of a hot key in one task.  Here rows are
merged in time order over ranges of (key, time), and the last reading is carried
from range to range:

1. the left side is cut down to its distinct (key, time) pairs and the readings to
   the last one of each (key, time), both with partial aggregates on every task;
2. pairs and readings are range-partitioned by (key, time) and sorted, so a hot key
   spreads over as many ranges as its times fill;
3. inside a range a running ``last`` fills the pairs.  What a range lacks is the last
   reading of the ranges before it, from a table of one row per range; it counts if
   it has the same key;
4. the answers, one row per distinct pair, go back to the left rows.  Where they fit a
   broadcast the left rows do not move at all; otherwise Spark shuffles them on
   (key, time) and splits a hot pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.clean import q
from starmart.operators.joins import lookup_join

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _last_readings(right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
                   order_by: Sequence[str]) -> DataFrame:
    """(key, time, reading) of the last reading of each key and time."""
    reading = F.struct(*[q(c).alias(c) for c in values])
    order = F.struct(*[q(c) for c in (*order_by, *[v for v in values if v not in order_by])])
    known = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, time)))
    return (known.groupBy(F.struct(*[q(c) for c in keys]).alias("key"), q(time).alias("time"))
            .agg(F.max_by(reading, order).alias("reading")))


def _ranges(pairs: DataFrame, readings: DataFrame, num_partitions: int | None) -> DataFrame:
    """Pairs and readings (key, time, reading) in time order, with the number of
    their range and the place in it.  At the same time readings stand first."""
    merged = pairs.withColumn("reading", F.lit(None).cast(readings.schema["reading"].dataType))
    merged = merged.withColumn("is_pair", F.lit(1)).unionByName(
        readings.withColumn("is_pair", F.lit(0)))
    order = [F.col(c) for c in ("key", "time", "is_pair")]
    ranged = (merged.repartitionByRange(num_partitions, *order) if num_partitions
              else merged.repartitionByRange(*order))
    # Both uses below must see the same ranges, whose bounds are sampled.
    place = F.monotonically_increasing_id()
    return (ranged.sortWithinPartitions(*order).checkpoint(eager=True)
            .select("*", F.shiftright(place, _LOCAL_BITS).alias("range"), place.alias("place")))


def asof_pairs(pairs: DataFrame, readings: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(key, time, reading) of distinct pairs (key, time): the reading of the same key
    with the greatest time that is not later; null without one."""
    ranges = _ranges(pairs, readings, num_partitions)
    held = F.struct("key", "reading")
    known = F.when(F.col("is_pair") == 0, held)
    # One row per range, so the window over them is bounded by their number.
    ends = ranges.groupBy("range").agg(F.max_by(held, F.when(F.col("is_pair") == 0, F.col("place")))
                                       .alias("end"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("range").alias("_range"),
                          F.last("end", ignorenulls=True).over(before).alias("carried"))
    inside = (Window.partitionBy("range").orderBy("place")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = ranges.withColumn("seen", F.last(known, ignorenulls=True).over(inside))
    met = (filled.where("is_pair = 1").join(carried, F.col("range") == F.col("_range"))
           .withColumn("last", F.coalesce("seen", "carried")))
    return met.select("key", "time", F.when(F.col("last.key") == F.col("key"),
                                            F.col("last.reading")).alias("reading"))


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_time: str,
              right_time: str, values: Sequence[str], order_by: Sequence[str] = (),
              num_partitions: int | None = None) -> DataFrame:
    """``left`` with the columns ``values`` of the last row of ``right`` that has the
    same key (``on``: pairs of a left and a right column) and a time not after
    ``left_time``; null where there is none.

    Every left row stays, once.  Among readings of one key and time the greatest by
    ``order_by``, then ``values``, counts.  Null keys and times meet nothing.
    ``values`` may carry names that ``left`` has: they must not, and this raises.
    """
    clash = [v for v in values if v in left.columns]
    if clash:
        raise ValueError(f"rename the columns {clash}: both sides have them")
    keys = [k for k, _ in on]
    readings = _last_readings(right.withColumnsRenamed({r: k for k, r in on if r != k}), keys,
                              right_time, values, order_by)
    pairs = (left.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, left_time)))
             .select(F.struct(*[q(k) for k in keys]).alias("key"), q(left_time).alias("time"))
             .distinct())
    found = asof_pairs(pairs, readings, num_partitions).where("reading IS NOT NULL").select(
        *[F.col(f"key.`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("time").alias("_time"), *[F.col(f"reading.`{v}`").alias(v) for v in values])

    def same() -> Column:
        out = q(left_time) == F.col("_time")
        for i, k in enumerate(keys):
            out = out & (q(k) == F.col(f"_key{i}"))
        return out
    return lookup_join(left, found, [same()], "left", stage=True).select(
        *[q(c) for c in left.columns], *[q(v) for v in values])
