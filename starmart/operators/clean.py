"""Cleaning operators (P1, P2, F1-F4, A6, A7) and the three cleaning steps
(C1-C3).  Functions return DataFrames and run no action."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas


def q(name: str):
    """A column reference that tolerates spaces, dots and dashes in names."""
    return F.col(f"`{name}`")


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop named columns; absent names are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; every source name must exist (a typo must not pass)."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename absent columns {missing}; have {df.columns}")
    return df.withColumnsRenamed(dict(mapping))


def drop_all_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """drop rows where every (subset) column is NULL or NaN."""
    return df.dropna(how="all", subset=list(subset) if subset else None)


def drop_any_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows where any subset column is NULL (or NaN for doubles)."""
    return df.dropna(how="any", subset=list(subset))


def deduplicate(df: DataFrame, keys: Sequence[str],
                order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys`` (NULL is a key value, as in ``dropDuplicates``).

    The survivor is the first row in (order_by..., other columns...) order,
    NULLs first, so equal inputs give equal results however they are laid out.
    Without ``order_by`` that is the order of the other columns.

    Skew: ``row_number() = 1`` plans a partial ``WindowGroupLimit`` before the
    shuffle, so every map task keeps one row per key and a key holding a
    third of all rows never lands whole in one task.
    """
    keys, order_by = list(keys), list(order_by or ())
    order = order_by + [c for c in df.columns if c not in keys and c not in order_by]
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(
        *[q(c).asc_nulls_first() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


# ---------------------------------------------------------------- C1 - C3

def clean_arrivals(df: DataFrame,
                   sparse_columns: Sequence[str] | str = schemas.SPARSE_ARRIVAL_COLUMNS,
                   sparse_threshold_pct: float = 90.0) -> DataFrame:
    """Drop the sparse columns, then rows with every remaining column empty.

    ``sparse_columns="auto"`` finds them with the missing-value profile
    (more than ``sparse_threshold_pct`` missing; runs one aggregate job).  The
    schema of the result then depends on the data.
    """
    if isinstance(sparse_columns, str) and sparse_columns == "auto":
        from starmart.operators.profile import sparse_column_names
        sparse_columns = sparse_column_names(df, sparse_threshold_pct)
    return drop_all_missing(drop_columns(df, sparse_columns))


def clean_temperatures(df: DataFrame, order_by: Sequence[str] | None = None,
                       keys: Sequence[str] = schemas.TEMPERATURE_KEYS) -> DataFrame:
    """Drop readings without a temperature, then one reading per key."""
    return deduplicate(drop_any_missing(df, ["AverageTemperature"]), keys, order_by)


def clean_demographics(df: DataFrame, order_by: Sequence[str] | None = None,
                       keys: Sequence[str] = schemas.DEMOGRAPHICS_KEYS,
                       measures: Sequence[str] = schemas.DEMOGRAPHICS_MEASURES) -> DataFrame:
    """Drop rows missing any measure, then one row per (city, state, race)."""
    return deduplicate(drop_any_missing(df, measures), keys, order_by)


# ---------------------------------------------------------------- A7

def _present(df: DataFrame, cols: Sequence[str]) -> list:
    """Per column: not missing as ``dropna`` sees it (NaN too for floats)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in cols:
        col = q(c)
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            out.append(col.isNotNull() & ~F.isnan(col))
        else:
            out.append(col.isNotNull())
    return out


def step_counts(df: DataFrame, table: str, steps: Sequence[tuple]) -> DataFrame:
    """Rows in/out per cleaning step, from ONE aggregate over ``df``.

    ``steps`` is a sequence of ``(name, kind, cols)`` applied in order, kind
    being ``"all"`` / ``"any"`` (dropna) or ``"dedup"`` (distinct ``cols``
    among surviving rows, NULL counting as a value).  Output columns:
    ``table_name, step_no, step, rows_in, rows_out, removed``.
    """
    kept = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("n0")]
    for i, (_, kind, cols) in enumerate(steps, start=1):
        if kind in ("all", "any"):
            combine = operator.or_ if kind == "all" else operator.and_
            kept = kept & reduce(combine, _present(df, cols))
            aggs.append(F.count_if(kept).alias(f"n{i}"))
        elif kind == "dedup":
            # A struct is never NULL, so NULL keys count as one value each.
            aggs.append(F.count_distinct(F.when(kept, F.struct(*[q(c) for c in cols])))
                        .alias(f"n{i}"))
            break
        else:
            raise ValueError(f"unknown step kind {kind!r}")
    totals = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                     F.col(f"n{i - 1}").alias("rows_in"), F.col(f"n{i}").alias("rows_out"))
            for i, (name, _, _) in enumerate(steps[:len(aggs) - 1], start=1)]
    return (totals.select(F.explode(F.array(*rows)).alias("r"))
            .select(F.lit(table).alias("table_name"), "r.*")
            .withColumn("removed", F.col("rows_in") - F.col("rows_out")))


def arrival_steps(cols: Sequence[str]) -> list[tuple]:
    return [("dropna_all", "all", list(cols))]


TEMPERATURE_STEPS = [("dropna_temperature", "any", ["AverageTemperature"]),
                     ("dedup", "dedup", list(schemas.TEMPERATURE_KEYS))]
DEMOGRAPHICS_STEPS = [("dropna_measures", "any", list(schemas.DEMOGRAPHICS_MEASURES)),
                      ("dedup", "dedup", list(schemas.DEMOGRAPHICS_KEYS))]


def clean_report(arrivals: DataFrame, temperatures: DataFrame,
                 demographics: DataFrame) -> DataFrame:
    """One report of the three cleaning steps; each input is scanned once."""
    a = drop_columns(arrivals, schemas.SPARSE_ARRIVAL_COLUMNS)
    return (step_counts(a, "arrivals", arrival_steps(a.columns))
            .unionByName(step_counts(temperatures, "temperatures", TEMPERATURE_STEPS))
            .unionByName(step_counts(demographics, "demographics", DEMOGRAPHICS_STEPS)))
