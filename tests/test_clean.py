import pytest
from pyspark.sql import functions as F

from starmart.operators import clean as C


def test_dropna_all_and_any(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (1.0, 2.0)], "a double, b double")
    assert C.drop_all_missing(df).count() == 2
    assert C.drop_any_missing(df, ["a", "b"]).count() == 1


def test_dropna_drops_nan_for_doubles(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "t double")
    assert C.drop_any_missing(df, ["t"]).count() == 1


def test_rename_absent_column_raises(spark):
    df = spark.createDataFrame([(1.0,)], "cicid double")
    with pytest.raises(ValueError):
        C.rename_columns(df, {"ccid": "record_id"})
    assert C.rename_columns(df, {"cicid": "record_id"}).columns == ["record_id"]


def test_drop_absent_columns_ignored(spark):
    df = spark.createDataFrame([(1.0, "x")], "a double, occup string")
    assert C.drop_columns(df, ["occup", "insnum"]).columns == ["a"]


def test_dedup_tie_break(spark):
    df = spark.createDataFrame([("2020-01-01", "c", "k", 2.0, 2), ("2020-01-01", "c", "k", 1.0, 1),
                                ("2020-01-02", "c", "k", 5.0, 3)],
                               "dt string, City string, Country string, t double, o int")
    out = C.deduplicate(df, ["dt", "City", "Country"], order_by=["o"])
    assert out.columns == df.columns
    got = sorted((r.dt, r.t) for r in out.collect())
    assert got == [("2020-01-01", 1.0), ("2020-01-02", 5.0)]


def test_dedup_null_key_is_a_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, o int")
    out = C.deduplicate(df, ["k"], order_by=["o"])
    assert sorted((r.k or "", r.o) for r in out.collect()) == [("", 1), ("a", 3)]


def test_dedup_idempotent(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    once = C.deduplicate(df, ["k"], order_by=["o"])
    twice = C.deduplicate(once, ["k"], order_by=["o"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_step_counts(spark):
    df = spark.createDataFrame([(None, "a"), (1.0, "a"), (2.0, "a"), (3.0, "b")],
                               "AverageTemperature double, k string")
    rep = C.step_counts(df, "t", [("drop", "any", ["AverageTemperature"]),
                                  ("dedup", "dedup", ["k"])])
    rows = [(r.step, r.rows_in, r.rows_out, r.removed) for r in rep.orderBy("step_no").collect()]
    assert rows == [("drop", 4, 3, 1), ("dedup", 3, 2, 1)]


def test_dedup_limits_each_group_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = C.deduplicate(df, ["k"], order_by=["o"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[ex + 1:]), plan
