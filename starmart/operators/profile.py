"""Profiling.

Each profile is one aggregate over the table (one scan, partial aggregation
on every task) followed by an unpivot of a single row; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.missing import is_missing
from starmart.operators.clean import q


def row_count(df: DataFrame, name: str | None = None) -> DataFrame:
    """A1 as a DataFrame: ``(table_name, n_rows)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).cast("string").alias("table_name"), "n_rows")


def missing_profile(df: DataFrame) -> DataFrame:
    """C4: ``(cols, values, pct_missing)``, one row per column, in one scan.

    ``values`` counts NULLs (and NaN per ``is_missing``); ``pct_missing`` is
    NULL for an empty table instead of a division error.
    """
    fields = df.schema.fields
    wide = df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count_if(is_missing(f"`{f.name}`", f.dataType)).alias(f"_m{i}")
                    for i, f in enumerate(fields)])
    long = wide.select(
        "_total",
        F.explode(F.array(*[F.struct(F.lit(f.name).alias("cols"), F.col(f"_m{i}").alias("values"))
                            for i, f in enumerate(fields)])).alias("_r"))
    return long.select(
        "_r.cols", "_r.values",
        F.try_divide(F.col("_r.values") * 100, F.col("_total")).alias("pct_missing"))


def missing_nonzero(profile: DataFrame) -> DataFrame:
    """profile rows of columns that have any missing value."""
    return profile.where(F.col("pct_missing") > 0)


def sparse_columns(profile: DataFrame, threshold_pct: float = 90.0) -> DataFrame:
    """Columns whose share of missing values exceeds ``threshold_pct``."""
    return profile.where(F.col("pct_missing") > F.lit(threshold_pct)).select("cols", "pct_missing")


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(n_rows, n_distinct, n_duplicates)`` on ``keys``.

    Counts what ``dropDuplicates(keys)`` would remove: NULL is one key value.
    """
    distinct_key = F.count_distinct(F.struct(*[q(k) for k in keys]))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct_key.alias("n_distinct")).select(
        "n_rows", "n_distinct", (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"))


def schema_report(df: DataFrame) -> DataFrame:
    """``(position, column_name, data_type, n_rows, n_nulls)`` per column."""
    fields = df.schema.fields
    wide = df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count_if(q(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"_n{i}").alias("n_nulls")) for i, f in enumerate(fields)]
    return (wide.select(F.col("_total").alias("n_rows"), F.explode(F.array(*rows)).alias("_r"))
            .select("_r.position", "_r.column_name", "_r.data_type", "n_rows", "_r.n_nulls"))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """R2: the first ``n`` rows in key order (a top-k, not an arbitrary sample)."""
    return df.orderBy(*[q(c).asc_nulls_first() for c in order_by]).limit(n)


def sparse_column_names(df: DataFrame, threshold_pct: float = 90.0) -> list[str]:
    """C5 as a decision: names of columns more than ``threshold_pct`` missing.

    One aggregate over ``df``; only the column names come back to the driver
    (bounded by the number of columns).
    """
    return [r.cols for r in sparse_columns(missing_profile(df), threshold_pct).collect()]
