"""Quality checks (Q1, Q2) as DataFrames, plus an assertion that raises."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.profile import row_count


def row_count_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: ``(table_name, n_rows, passed)``; passes when the table is not empty."""
    parts = [row_count(df, name) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("n_rows") > 0)


def referential_checks(fact: DataFrame, checks: Mapping[str, tuple],
                       weight: str | None = None) -> DataFrame:
    """Q2: ``(check_name, orphans, null_keys, passed)``.

    ``checks`` maps a name to ``(fact_key, dim_df, dim_key)``.  ``orphans`` are
    fact rows whose key has no dimension row; ``null_keys`` are rows without a
    key, which is sound (a NULL never joins).  A check passes without orphans.
    With ``weight`` a row of ``fact`` stands for as many rows as that column says.

    One pass over the fact counts the rows of every key of every check (partial
    aggregates on every task); only those counts meet the dimensions.
    """
    names = list(checks)
    fact_keys = F.array(*[F.struct(F.lit(n).alias("check_name"),
                                   F.col(checks[n][0]).cast("string").alias("key"))
                          for n in names])
    rows = F.sum("_rows") if weight else F.count(F.lit(1))
    counts = (fact.select(F.explode(fact_keys).alias("k"), *([F.col(weight).alias("_rows")] if weight else []))
              .groupBy("k.check_name", "k.key").agg(rows.alias("n")))
    dims = None
    for n in names:
        _, dim, key = checks[n]
        part = dim.select(F.lit(n).alias("_check"), F.col(key).cast("string").alias("_key"))
        dims = part if dims is None else dims.unionByName(part)
    met = counts.join(dims.where("_key is not null").distinct(),
                      (F.col("check_name") == F.col("_check")) & (F.col("key") == F.col("_key")),
                      "left")
    none = F.col("key").isNull()
    found = met.groupBy("check_name").agg(
        F.sum(F.when(~none & F.col("_key").isNull(), F.col("n"))).alias("orphans"),
        F.sum(F.when(none, F.col("n"))).alias("null_keys"))
    every = (fact.sparkSession.range(1)
             .select(F.explode(F.array(*[F.lit(n) for n in names])).alias("check_name")))
    return (every.join(found, "check_name", "left").select(
        "check_name", F.coalesce("orphans", F.lit(0)).alias("orphans"),
        F.coalesce("null_keys", F.lit(0)).alias("null_keys"))
        .withColumn("passed", F.col("orphans") == 0))


def assert_quality(results: DataFrame, show: int = 20) -> None:
    """Raise if any check row has ``passed = false``; the message says how many
    failed and lists the first ``show`` of them."""
    failed = results.where(~F.col("passed"))
    n = failed.count()
    if n:
        rows = [r.asDict() for r in failed.limit(show).collect()]
        raise AssertionError(f"{n} quality checks failed: {rows}")
