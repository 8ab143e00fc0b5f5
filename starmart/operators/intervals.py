"""Interval join: pairs of rows with equal keys whose time intervals overlap.

A plain overlap condition is no equality, so Spark could only compare every pair of a
key.  Here time is cut into bins of several widths, each ``_FAN`` times the one below;
the finest is as wide as the usual interval, so most rows are listed once or twice.
An interval belongs to the finest level at which it covers at most ``_FAN`` bins, and
is listed under the bins it covers there and at every coarser level up to that of the
longest row.  A pair is joined at the coarser one of its two levels, by an equality on
(keys, level, bin), and is emitted in its first common bin only.  A copy of a row that
is shuffled holds, beside the row, its cell (level and bin) and its mark: two numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.clean import q

_FAN = 32
#: Bits of a copy's mark: its level is the row's own, its bin is the row's first.
_OWN, _FIRST = 1, 2


def _spans(df: DataFrame) -> tuple[int, int]:
    """Longest and median length of a side's intervals."""
    length = F.col("_end") - F.col("_start")
    longest, usual = df.agg(F.max(length), F.percentile_approx(length, 0.5)).first()
    return longest or 0, usual or 0


def _levels(left: DataFrame, right: DataFrame, base: int) -> int:
    """Levels that the longest interval of either side needs."""
    return _levels_of(max(_spans(left)[0], _spans(right)[0]), base)


def _levels_of(longest: int, base: int) -> int:
    levels, width = 1, base
    while longest // width + 1 > _FAN:
        levels, width = levels + 1, width * _FAN
    return levels


def _number(c: Column) -> Column:
    """Days of a date, seconds of a timestamp, as a number."""
    return F.unix_seconds(c.cast("timestamp"))


def _binned(df: DataFrame, base: int, levels: int, side: str) -> DataFrame:
    """One row per level from the row's own one up, and bin covered there."""
    own = F.lit(levels - 1)
    for level in range(levels - 1, -1, -1):
        width = base * _FAN ** level
        own = F.when((F.col("_end") - F.col("_start")) / width + 1 <= _FAN, level).otherwise(own)
    width = F.element_at(F.array(*[F.lit(base * _FAN ** n).cast("long") for n in range(levels)]),
                         F.col("_level") + 1)
    at = lambda c: F.floor(F.col(c) / width)
    mark = (F.when(F.col("_level") == F.col("_own"), _OWN).otherwise(0)
            + F.when(F.col("_bin") == F.col("_first"), _FIRST).otherwise(0))
    return (df.withColumn("_own", own)
            .withColumn("_level", F.explode(F.sequence("_own", F.lit(levels - 1))))
            .withColumn("_first", at("_start"))
            .withColumn("_bin", F.explode(F.sequence("_first", at("_end"))))
            .withColumns({f"_cell_{side}": F.col("_bin") * levels + F.col("_level"),
                          f"_mark_{side}": mark})
            .drop("_start", "_end", "_own", "_level", "_first", "_bin"))


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                  left_interval: tuple[str, str], right_interval: tuple[str, str],
                  base_seconds: int = 86_400, left_lengths: DataFrame | None = None) -> DataFrame:
    """Rows of ``left`` with rows of ``right`` of equal keys (``on``: pairs of a left
    and a right column) and overlapping closed intervals (start and end columns,
    dates or timestamps): one row per pair, with the columns of both sides.

    Intervals that share an end overlap.  Null keys and ends, and intervals that end
    before they start, meet nothing.  Equal rows are rows of their own.  The sides must
    not share column names.  The finest bin is at least ``base_seconds`` wide; results do
    not depend on it.  Bins are chosen by the lengths of the sides' intervals; where the
    left side is costly, ``left_lengths`` names a table that holds its intervals, others
    too, and is read for them instead.  Results do not depend on it either.
    """
    clash = sorted(set(left.columns) & set(right.columns))
    if clash:
        raise ValueError(f"rename the columns {clash}: both sides have them")

    def prepared(df: DataFrame, interval: tuple[str, str], keys: Sequence[str]) -> DataFrame:
        df = df.withColumns({"_start": _number(q(interval[0])), "_end": _number(q(interval[1]))})
        # The whole value decides overlap; its second only the bins.
        df = df.where((q(interval[0]) <= q(interval[1])) & F.col("_start").isNotNull())
        for k in keys:
            df = df.where(q(k).isNotNull())
        return df
    a = prepared(left, left_interval, [k for k, _ in on])
    b = prepared(right, right_interval, [k for _, k in on])
    measured = a if left_lengths is None else prepared(left_lengths, left_interval, [])
    (long_a, usual_a), (long_b, usual_b) = _spans(measured), _spans(b)
    # Half of a side's rows are about as long as a bin or longer, so rows that share a
    # bin without overlapping are no more than some times those that overlap.
    base = max(base_seconds, 2 * max(usual_a, usual_b))
    levels = _levels_of(max(long_a, long_b), base)
    a, b = _binned(a, base, levels, "l"), _binned(b, base, levels, "r")
    same = F.col("_cell_l") == F.col("_cell_r")
    for x, y in on:
        same = same & (q(x) == q(y))
    marks = F.col("_mark_l").bitwiseOR(F.col("_mark_r"))
    met = a.join(b, same & (marks == (_OWN | _FIRST))
                 & (q(left_interval[0]) <= q(right_interval[1]))
                 & (q(right_interval[0]) <= q(left_interval[1])))
    return met.select(*[q(c) for c in left.columns], *[q(c) for c in right.columns])
