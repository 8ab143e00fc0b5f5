from pyspark.sql import functions as F

from starmart.operators.keys import assign_key


def _ids(spark, n_parts):
    df = spark.range(0, 500, numPartitions=5).select(
        ((F.col("id") * 7919) % 1000).alias("k")).distinct()
    out = assign_key(df, "k", "id", num_partitions=n_parts)
    return sorted((r.k, r.id) for r in out.collect())


def test_dense_and_stable_across_partition_counts(spark):
    a, b, c = _ids(spark, 1), _ids(spark, 3), _ids(spark, 8)
    assert a == b == c
    assert [i for _, i in a] == list(range(len(a)))
    assert [k for k, _ in a] == sorted(k for k, _ in a)


def test_null_key_gets_zero(spark):
    df = spark.createDataFrame([("B1",), (None,), ("A2",)], "visatype string")
    out = {r.visatype: r.visa_type_key for r in assign_key(df, "visatype", "visa_type_key").collect()}
    assert out == {None: 0, "A2": 1, "B1": 2}


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string")
    assert assign_key(df, "k").count() == 0


def test_multi_column_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "x string, y int")
    got = sorted((r.id, r.x, r.y) for r in assign_key(df, ["x", "y"]).collect())
    assert got == [(0, "a", 1), (1, "a", 2), (2, "b", 1)]
