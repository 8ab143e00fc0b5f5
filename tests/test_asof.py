"""As-of join: against a plain search, hot keys over several ranges, corner cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import asof

LEFT = "id long, country string, day date"
RIGHT = "c string, dt date, city string, t double"


def day(n):
    return None if n is None else dt.date(2016, 1, 1) + dt.timedelta(n)


def tables(spark, seed, n=300, m=120):
    rng = random.Random(seed)
    pick = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None, ""])
    left = [(i, pick(), day(rng.choice([None, *range(60)]))) for i in range(n)] + [(0, "a", day(3))] * 2
    right = [(pick(), day(rng.choice([None, *range(0, 60, 3)])), rng.choice("xyz"),
              rng.choice([None, 1.5, 2.5])) for _ in range(m)]
    return left, right


def brute(left, right):
    out = []
    low = lambda v: (v is not None, v)
    for i, c, d in left:
        best = None
        for k, t, city, value in right:
            if None not in (c, d, k, t) and k == c and t <= d:
                x = (t, city, low(value))
                best = max(best, x) if best else x
        out.append((i, c, d, *((best[0], best[1], best[2][1]) if best else (None,) * 3)))
    return sorted(out, key=str)


def joined(spark, left, right, parts=None):
    r = spark.createDataFrame(right, RIGHT).withColumn("read_on", F.col("dt"))
    return asof.asof_join(spark.createDataFrame(left, LEFT), r, [("country", "c")], "day", "dt",
                          ["read_on", "city", "t"], ["city"], parts)


@pytest.mark.parametrize("parts", [None, 1, 7, 64])
def test_equals_a_plain_search(spark, parts):
    left, right = tables(spark, 3)
    got = joined(spark, left, right, parts)
    assert got.columns == ["id", "country", "day", "read_on", "city", "t"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right)


def test_a_hot_key_spreads_over_ranges(spark):
    """One country holds every row; its last reading crosses many ranges."""
    pairs = spark.range(4000).select(F.struct(F.lit("hot").alias("country")).alias("key"),
                                     (F.col("id") * 2 + 1).alias("time"))
    readings = spark.createDataFrame([(t, t) for t in (0, 5, 4001)], "time long, v long").select(
        F.struct(F.lit("hot").alias("country")).alias("key"), "time", F.struct("v").alias("reading"))
    ranges = asof._ranges(pairs, readings, 16)
    sizes = [r["count"] for r in ranges.groupBy("range").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000
    for r in asof.asof_pairs(pairs, readings, 16).collect():
        assert r.reading.v == (0 if r.time < 5 else 5 if r.time < 4001 else 4001)


def test_the_left_side_is_cut_down_before_it_moves(spark):
    """Distinct pairs are counted on every task; only they are sorted by range."""
    left = spark.range(100_000).select("id", F.when(F.col("id") >= 0, "hot").alias("country"),
                                       F.date_add(F.lit(day(3)), F.col("id").cast("int") % 2).alias("day"))
    right = spark.createDataFrame([("hot", day(1), "x", 1.0)], RIGHT)
    out = asof.asof_join(left, right, [("country", "c")], "day", "dt", ["city", "t"])
    assert out.where("t = 1.0").count() == 100_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "EvalPython" not in plan


def test_corner_cases(spark):
    left, right = tables(spark, 5, 20, 10)
    assert joined(spark, [], right).count() == 0
    assert all(r.city is None for r in joined(spark, left, []).collect())
    with pytest.raises(ValueError):
        asof.asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT),
                       [("country", "c")], "day", "dt", ["id"])
