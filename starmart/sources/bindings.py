"""Bind the driver's TPC-H-style tables to the four inputs of the star.

The driver tables hold no NULLs in the columns used, so fixed rules inject
them, as well as NaN, the text 'NaN', repeated keys, empty rows and dates without
a value: they replace values, they never drop rows.  The same rules are written
as DuckDB CTEs in ``oracle_sql.py``.

Joins between base tables are plain joins: Spark sizes each side from file
statistics (broadcast under ``spark.sql.autoBroadcastJoinThreshold``) and AQE
re-plans from measured shuffle sizes, splitting skewed keys; at scale
``orders x customer`` is a sort-merge join.

- arrivals:        orders LEFT JOIN customer, one event per order
- country_mapping: nation (code, Name)
- temperatures:    lineitem LEFT JOIN supplier LEFT JOIN nation, one reading per line
- demographics:    customer, one (city, state, race) row per customer
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import title_case


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(key: Column, n: int) -> Column:
    # Fixed NULL-injection rule: every n-th key (a value rule, not a filter).
    return (key % F.lit(n)) == 0


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                               "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    nan = F.lit(float("nan"))
    days = F.datediff(day, F.lit("1960-01-01").cast("date")).cast("double")
    events = (o.join(c, o.o_custkey == c.c_custkey, "left")
              .select(
                  k.alias("_k"),
                  F.when(_every(k, 109), F.lit(None))
                   .when(_every(k, 113), k - 1)
                   .otherwise(k).cast("double").alias("cicid"),
                  F.year(day).cast("double").alias("i94yr"),
                  F.month(day).cast("double").alias("i94mon"),
                  F.when(_every(k, 103), F.lit(99.0))
                   .when(_every(k, 107), F.lit(None))
                   .when(_every(k, 131), nan)
                   .otherwise(F.col("c_nationkey").cast("double")).alias("i94res"),
                  F.when(_every(k, 101), F.lit(None))
                   .when(_every(k, 127), nan)
                   .when(_every(k, 139), F.lit(0.0))
                   .when(_every(k, 7), days + 0.75)
                   .otherwise(days).alias("arrdate"),
                  F.when(_every(k, 97), F.lit(None))
                   .when(_every(k, 137), F.lit("NaN"))
                   .otherwise(F.col("o_orderpriority")).alias("visatype"),
                  F.substring("c_mktsegment", 1, 2).alias("i94addr"),
                  F.lit(1.0).alias("count"),
                  F.when(_every(k, 20), F.lit("STU")).alias("occup"),
                  F.when(_every(k, 11), F.lit("U")).alias("entdepu"),
                  F.lit(None).cast("string").alias("insnum"),
              ))
    # Every 211th event is empty.
    return events.select(*[F.when(~_every(F.col("_k"), 211), F.col(x)).alias(x)
                           for x in events.columns if x != "_k"])


def country_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"),
                                                  F.col("n_name").alias("Name"))


# Columns of lineitem kept on each reading: together they order duplicates.
TEMPERATURE_TIEBREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        "l_quantity", "l_extendedprice")


def temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(*TEMPERATURE_TIEBREAK, "l_shipdate")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # Title-case the nation names on the nation side (one row per nation),
    # not once per reading after the join.
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name",
                                               title_case("n_name").alias("_title"))
    # Each small side is a base table, so Spark sizes it from file statistics
    # (a join result would be estimated as the product of its inputs).
    joined = (li.join(s, li.l_suppkey == s.s_suppkey, "left")
              .join(n, F.col("s_nationkey") == n.n_nationkey, "left"))
    return joined.select(
        F.to_date("l_shipdate").alias("dt"),
        F.col("s_name").alias("City"),
        # Two spellings of each country.
        F.when(F.col("l_linenumber") % 3 == 0, F.col("n_name"))
         .otherwise(F.col("_title")).alias("Country"),
        F.when(F.col("l_linenumber") == 7, F.lit(None))
         .when(F.col("l_partkey") % 53 == 0, F.lit(float("nan")))
         .otherwise(F.col("l_quantity") - 10).alias("AverageTemperature"),
        *TEMPERATURE_TIEBREAK,
    )


DEMOGRAPHICS_TIEBREAK = ("c_custkey",)


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                 "c_mktsegment")
    # Fixed values for the measures the driver tables do not carry, each missing
    # on some rows.
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("City_"), F.col("c_nationkey").cast("string")).alias("City"),
        F.col("c_mktsegment").alias("State"),
        F.lit(35.5).alias("Median Age"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.lit(30000))
         .alias("Male Population"),
        F.when(~_every(k, 29), F.lit(35000)).alias("Female Population"),
        (F.lit(65000) + F.col("c_nationkey") * 1000).alias("Total Population"),
        F.when(~_every(k, 31), F.lit(5000)).alias("Number of Veterans"),
        F.when(~_every(k, 37), F.lit(10000)).alias("Foreign-born"),
        F.when(_every(k, 41), F.lit(float("nan")))
         .when(~_every(k, 43), F.lit(2.5)).alias("Average Household Size"),
        F.substring("c_mktsegment", 1, 2).alias("State Code"),
        F.concat(F.lit("Race_"), (F.col("c_custkey") % 5).cast("string")).alias("Race"),
        F.lit(1000).alias("Count"),
        F.col("c_custkey"),
    )
