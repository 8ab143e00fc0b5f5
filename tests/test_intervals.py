"""Interval join, presence and rollup against plain versions."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from starmart.operators import intervals
from starmart.operators.rollup import distinct_rollup
from starmart.plans.presence import presence_by_day

START = dt.date(2016, 1, 1)


def day(n):
    return None if n is None else START + dt.timedelta(n)


def spans(rng, n, longest):
    out = []
    for i in range(n):
        s = rng.randrange(400)
        e = s + rng.choice([0, 1, 5, rng.randrange(longest)])
        out.append((i, rng.choice(["hot", "hot", "a", None]), day(s), day(e)))
    return out + [(n, "a", day(50), day(20)), (n + 1, "a", None, day(3)), (n + 2, "a", day(3), None),
                  (n + 3, "hot", day(0), day(399)), (0, *out[0][1:])]


def join(spark, a, b, base=86_400):
    left = spark.createDataFrame(a, "i long, k string, s date, e date")
    right = spark.createDataFrame(b, "j long, c string, from date, to date")
    return intervals.interval_join(left, right, [("k", "c")], ("s", "e"), ("from", "to"), base)


@pytest.mark.parametrize("base", [86_400, 3_600, 40 * 86_400])
def test_each_overlapping_pair_once(spark, base):
    rng = random.Random(1)
    a, b = spans(rng, 80, 300), spans(rng, 60, 20)
    got = join(spark, a, b, base)
    assert got.columns == ["i", "k", "s", "e", "j", "c", "from", "to"]
    expected = sorted((i, j) for i, k, s, e in a for j, c, f, t in b
                      if k and k == c and None not in (s, e, f, t) and s <= e and f <= t
                      and s <= t and f <= e)
    assert sorted((r.i, r.j) for r in got.collect()) == expected


def test_the_plan_compares_no_pairs(spark):
    rng = random.Random(2)
    plan = join(spark, spans(rng, 20, 300), spans(rng, 20, 20))._jdf.queryExecution().executedPlan()
    assert "NestedLoop" not in plan.toString() and "Cartesian" not in plan.toString()


def test_long_intervals_have_few_copies(spark):
    """Years in bins of an hour: a handful of rows per level."""
    rows = spark.createDataFrame([(1, 0, 10 * 365 * 86_400), (2, 5, 6)], "i long, _start long, _end long")
    levels = intervals._levels(rows, rows, 3600)
    copies = intervals._binned(rows, 3600, levels, "l").groupBy("i").count().collect()
    assert all(r["count"] <= levels * (intervals._FAN + 1) for r in copies)


def test_usual_intervals_are_listed_once_or_twice(spark, monkeypatch):
    """What is shuffled: few copies of a row, each with two numbers beside it."""
    binned, seen = intervals._binned, []

    def spy(df, *args):
        out = binned(df, *args)
        seen.append((out.count() / df.count(), len(out.columns) - len(df.columns) + 2))
        return out
    monkeypatch.setattr(intervals, "_binned", spy)
    rng = random.Random(5)
    a = [(i, "a", day(s), day(s + rng.randrange(1, 51))) for i in range(400) for s in [rng.randrange(900)]]
    b = [(i, "a", day(s), day(s + (1095 if i % 100 == 0 else 30))) for i in range(200)
         for s in [rng.randrange(900)]]
    got = join(spark, a, b)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted(
        (i, j) for i, _, s, e in a for j, _, f, t in b if s <= t and f <= e)
    assert all(copies < 2 and columns == 2 for copies, columns in seen) and len(seen) == 2


def test_interval_corner_cases(spark):
    a = [(1, "a", day(1), day(1))]
    assert join(spark, a, [(1, "a", day(1), day(1))]).count() == 1
    assert join(spark, a, []).count() == 0 and join(spark, [], a).count() == 0
    with pytest.raises(ValueError):
        d = spark.createDataFrame(a, "i long, k string, s date, e date")
        intervals.interval_join(d, d, [("k", "k")], ("s", "e"), ("s", "e"))


def test_presence(spark):
    rng = random.Random(3)
    rows = spans(rng, 150, 90)
    stays = spark.createDataFrame(rows, "i long, k string, s date, e date")
    got = presence_by_day(stays, "k", "s", "e")
    count, first, last = defaultdict(int), {}, {}
    for _, k, s, e in rows:
        if None in (s, e) or e < s:
            continue
        first[k], last[k] = min(first.get(k, s), s), max(last.get(k, e), e)
        for n in range((e - s).days + 1):
            count[k, s + dt.timedelta(n)] += 1
    expected = [(k, first[k] + dt.timedelta(n), count[k, first[k] + dt.timedelta(n)])
                for k in first for n in range((last[k] - first[k]).days + 2)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert presence_by_day(stays.limit(0), "k", "s", "e").count() == 0


def test_rollup_counts_distinct_values(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([None, *range(6)]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, v int")
    got = distinct_rollup(df, [["a", "b"], ["a"], []], "v").collect()
    expected = defaultdict(list)
    for a, b, v in rows:
        for key in ((a, b, 0), (a, None, 1), (None, None, 3)):
            expected[key].append(v)
    assert {(r.a, r.b, r.grouping): (r.n_rows, r.n_distinct) for r in got} == {
        k: (len(v), len({x for x in v if x is not None})) for k, v in expected.items()}
    plan = distinct_rollup(df, [["a", "b"], []], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate [a")  # cut down below the expansion
    assert distinct_rollup(df.limit(0), [["a"], []], "v").count() == 0
    with pytest.raises(ValueError):
        distinct_rollup(df, [[]], "v")


def test_weighted_rows_stand_for_many(spark):
    from starmart.plans.quality import referential_checks
    fact = spark.createDataFrame([(1, 5), (2, 7), (None, 2)], "k int, n long")
    dim = spark.createDataFrame([(1,)], "k int")
    r = referential_checks(fact, {"c": ("k", dim, "k")}, weight="n").first()
    assert (r.orphans, r.null_keys, r.passed) == (7, 2, False)


def test_transit_reads_lengths_before_its_join_and_merges(spark, tmp_path, monkeypatch):
    """One plan at every size: nothing is broadcast, and bins are chosen without the join."""
    from starmart.plans.catalog import join_interval_transit
    rng = random.Random(6)
    at = lambda n: dt.datetime(2016, 1, 1) + dt.timedelta(n)
    orders = [(500 + i, rng.randrange(5), at(rng.randrange(200))) for i in range(60)]
    lines = [(rng.randrange(495, 570), n, at(rng.randrange(200)), float(rng.randrange(1, 51)))
             for n in range(150)] + [(None, 1, at(3), 4.0), (501, 2, None, 4.0), (502, 2, at(3), None)]
    spark.createDataFrame(orders + [(None, 1, at(3)), (700, None, at(3)), (701, 2, None), orders[0]],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_shipdate timestamp, "
                          "l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spans, plans = intervals._spans, []

    def spy(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return spans(df)
    monkeypatch.setattr(intervals, "_spans", spy)
    met = join_interval_transit(spark, str(tmp_path))
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    every = orders + [orders[0]]
    want = sorted((k, n, o) for k, n, s, x in lines if k and s and x for key, owner, _ in every
                  if key == k for o, c, d in every if c == owner and s <= d + dt.timedelta(
                      1095 if o % 500 == 0 else 30) and d <= s + dt.timedelta(x))
    # An order without a key is a partner like any other, open for 30 days.
    none = sorted((k, n) for k, n, s, x in lines if k and s and x for key, owner, _ in every
                  if key == k and owner == 1 and s <= at(33) and at(3) <= s + dt.timedelta(x))
    got = met.collect()
    assert sorted(tuple(r)[:3] for r in got if r.o_orderkey is not None) == want
    assert sorted(tuple(r)[:2] for r in got if r.o_orderkey is None) == none
