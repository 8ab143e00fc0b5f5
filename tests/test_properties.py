"""Brute-force checks on small random inputs, and the broadcast bound."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.operators import clean as C
from pyspark.sql import functions as F

from starmart.operators.joins import lookup_join
from starmart.operators.keys import assign_key

rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc")),
                          st.integers(0, 3), st.integers(-5, 5)),
                min_size=0, max_size=40)


@settings(max_examples=20, deadline=None)
@given(rows)
def test_dedup_equals_brute_force(spark, data):
    data = [(k, g, i * 100 + v) for i, (k, g, v) in enumerate(data)]  # unique tie-break
    df = spark.createDataFrame(data, "k string, g int, o int")
    got = sorted(((r.k or "~"), r.g, r.o) for r in C.deduplicate(df, ["k", "g"], ["o"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "g", "o"]).fillna({"k": "~"})
    want = sorted(map(tuple, pdf.sort_values("o").groupby(["k", "g"], as_index=False).first()
                  [["k", "g", "o"]].itertuples(index=False)))
    assert got == [(k, int(g), int(o)) for k, g, o in want]


@settings(max_examples=15, deadline=None)
@given(st.sets(st.one_of(st.none(), st.integers(-1000, 1000)), max_size=60),
       st.integers(1, 6))
def test_assign_key_equals_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = {r.k: r.id for r in assign_key(df, "k", num_partitions=parts).collect()}
    ordered = ([None] if None in keys else []) + sorted(k for k in keys if k is not None)
    assert got == {k: i for i, k in enumerate(ordered)}


def test_broadcast_of_a_derived_side_follows_the_session_threshold(spark):
    left = spark.range(100)
    right = spark.range(40).select("id", F.repeat(F.lit("x"), 100).alias("wide"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
        small = lookup_join(left, right, "id", "left", stage=True)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300")  # bytes count, not rows
        big = lookup_join(left, right, "id", "left", stage=True)
        assert "BroadcastHashJoin" in plan(small)
        assert "BroadcastHashJoin" not in plan(big) and "SortMergeJoin" in plan(big)
        for d in (small, big):  # no limit gathers rows in one task
            assert "Limit" not in plan(d)
        assert small.count() == big.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
