"""Reconciliation of two loads as multisets: which rows does one hold more often?

First each side is reduced to a digest that knows no order: rows fall into buckets by a
hash, and a bucket is its row count and two sums of row hashes, summed on every task.
Only rows of buckets whose digests differ are counted and compared in full, so two
loads that agree cost one scan each and no shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.clean import q

BUCKETS = 4096


def _bucket(columns: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[q(c) for c in columns]), F.lit(buckets)).cast("int")


def table_digest(df: DataFrame, columns: Sequence[str] | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_rows, digest): equal for two tables of the same rows in any order
    and layout.  The sums are exact decimals of two 64-bit hashes; a null and an empty
    string hash apart, as the null pattern of a row is hashed along."""
    columns = list(columns or df.columns)
    nulls = F.concat_ws("", *[F.when(q(c).isNull(), "0").otherwise("1") for c in columns])
    hashes = [F.xxhash64(F.lit(seed), nulls, *[q(c) for c in columns]).cast("decimal(38,0)")
              for seed in (1, 2)]
    sums = F.struct(*[F.sum(h).alias(f"s{i}") for i, h in enumerate(hashes)])
    return df.groupBy(_bucket(columns, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), sums.alias("digest"))


def differing_buckets(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None,
                      buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose digests differ, or that only one side has."""
    columns = list(columns or left.columns)
    a = table_digest(left, columns, buckets)
    b = table_digest(right, columns, buckets).toDF("_bucket", "_n_rows", "_digest")
    met = a.join(b, F.col("bucket") == F.col("_bucket"), "full")
    same = F.col("n_rows").eqNullSafe(F.col("_n_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return met.where(~same).select(F.coalesce("bucket", "_bucket").alias("bucket"))


def reconcile(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None,
              buckets: int = BUCKETS) -> DataFrame:
    """Rows (``columns``, by default those of ``left``) that the sides hold a different
    number of times, with n_left and n_right.

    Nulls equal nulls and NaN equals NaN.  Rows are counted on every task before they
    move, so a row that makes up a third of a load moves once per task.  Equal loads,
    empty ones too, give an empty result.
    """
    columns = list(columns or left.columns)
    # At most ``buckets`` numbers: a list whose size does not follow the tables.
    differ = differing_buckets(left, right, columns, buckets).checkpoint(eager=True)
    differ = F.broadcast(differ.withColumnRenamed("bucket", "_bucket"))

    def counted(df: DataFrame, n_left: int, n_right: int) -> DataFrame:
        rows = df.select(*[q(c) for c in columns], _bucket(columns, buckets).alias("_b"))
        return (rows.join(differ, F.col("_b") == F.col("_bucket"), "left_semi").drop("_b")
                .withColumns({"_l": F.lit(n_left), "_r": F.lit(n_right)}))
    both = counted(left, 1, 0).unionByName(counted(right, 0, 1))
    return (both.groupBy(*[q(c) for c in columns])
            .agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
            .where("n_left <> n_right"))
