"""Totals over grouping sets with exact distinct counts.

Spark expands each input row once per grouping set.  Rows are therefore cut down to one
per combination of all dimensions and counted value before they are expanded, on every
task first; what is expanded and shuffled is bounded by those combinations, not by the
rows.  Distinct counts stay exact, as a combination is never lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.clean import q


def distinct_rollup(df: DataFrame, sets: Sequence[Sequence[str]], value: str,
                    distinct_as: str = "n_distinct", count_as: str = "n_rows") -> DataFrame:
    """One row per group of each of the grouping ``sets``: its dimensions (null where the
    set leaves one out), ``grouping`` (Spark's ``grouping_id``, by which a left-out
    dimension differs from a null member), rows, and distinct non-null values.  An empty
    table gives no rows, not even a grand total.
    """
    dims = list(dict.fromkeys(d for s in sets for d in s))
    if not dims:
        raise ValueError("grouping sets without a dimension: use an aggregate")
    held = df.groupBy(*[q(d) for d in dims], q(value).alias("_value")).agg(
        F.count(F.lit(1)).alias("_n"))
    grouped = held.groupingSets([[q(d) for d in s] for s in sets], *[q(d) for d in dims])
    return grouped.agg(F.grouping_id().alias("grouping"), F.sum("_n").alias(count_as),
                       F.count_distinct("_value").alias(distinct_as))
