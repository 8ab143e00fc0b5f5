"""A key holding a third of all rows: results stay whole and every shuffle of
event-sized data is preceded by a partial (map-side) aggregate."""

import re

from pyspark.sql import functions as F

from starmart.operators import clean as C
from starmart.plans import analytics as A
from starmart.plans import dims as M


def _skewed(spark, n=3000):
    # A third of the rows share visatype 'HOT', country 1.0 and one date.
    return spark.range(n).select(
        F.col("id").cast("double").alias("cicid"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise((F.col("id") % 50).cast("double"))
         .alias("i94res"),
        F.when(F.col("id") % 3 == 0, F.lit(20545.0)).otherwise(20000.0 + F.col("id") % 400)
         .alias("arrdate"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("V"), F.col("id") % 7))
         .alias("visatype"),
        F.lit("NY").alias("i94addr"), F.lit(1.0).alias("count"))


def _partial_before_exchange(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = "\n".join(lines[i + 1:i + 5])
            assert re.search(r"(Hash|Sort)Aggregate|WindowGroupLimit.*Partial", below), plan
    return plan


def test_visa_dim_distinct_is_partial(spark):
    ev = _skewed(spark)
    _partial_before_exchange(ev.select("visatype").distinct())
    assert M.visa_type_dim(ev).count() == 8


def test_dedup_hot_key_partial_and_whole(spark):
    ev = _skewed(spark)
    out = C.deduplicate(ev, ["arrdate"], order_by=["cicid"])
    _partial_before_exchange(out)
    got = {r.arrdate: r.cicid for r in out.collect()}
    assert got[20545.0] == 0.0
    assert len(got) == ev.select("arrdate").distinct().count()


def test_climate_pre_aggregates_hot_country(spark):
    ev = _skewed(spark).withColumnRenamed("i94res", "country_residence_code")
    dim = spark.createDataFrame([(1.0, "A", 20.0)], "country_code double, country_name string, "
                                                   "average_temperature double")
    out = A.arrivals_by_climate(ev, dim)
    _partial_before_exchange(out)
    got = {r.climate: r.arrivals for r in out.collect()}
    assert got["warm"] == 1000.0 + sum(1 for i in range(3000) if i % 3 and i % 50 == 1)
    assert sum(got.values()) == 3000.0
