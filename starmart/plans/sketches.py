"""Persisted aggregate states: distinct counts per day, merged to longer periods.

A day's distinct members are kept as a HyperLogLog state of fixed size, written as a
binary column.  States merge, so weeks, months or any other days are counted without
reading the events again; a day that is loaded again replaces its own state.  The
relative standard error of an estimate is about 1.04 / sqrt(2 ** bits), whatever the
number of members.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.clean import q

BITS = 14
DAY = "state_day"


def standard_error(bits: int = BITS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / sqrt(2 ** bits)


def daily_states(events: DataFrame, time: str, member: str, bits: int = BITS) -> DataFrame:
    """(state_day, n_rows, members): a state per day, made on every task and merged.
    Rows without a time are in no day; null members are rows, but no members."""
    known = events.where(q(time).isNotNull()).select(F.to_date(q(time)).alias(DAY),
                                                     q(member).cast("string").alias("_member"))
    return known.groupBy(DAY).agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.hll_sketch_agg("_member", F.lit(bits)).alias("members"))


def save_states(states: DataFrame, path: str) -> None:
    """Write states, one partition per day: days that are written again replace their
    own partitions and no others."""
    (states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))


def merged_counts(spark: SparkSession, path: str, period: str = "month") -> DataFrame:
    """(period_start, n_rows, n_members) per ``period`` (a unit of ``date_trunc``) from
    the states at ``path``; n_members is an estimate."""
    start = F.to_date(F.date_trunc(period, F.col(DAY).cast("timestamp")))
    return (spark.read.parquet(path).groupBy(start.alias("period_start"))
            .agg(F.sum("n_rows").alias("n_rows"),
                 F.hll_sketch_estimate(F.hll_union_agg("members")).alias("n_members")))
