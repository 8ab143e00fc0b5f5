"""Lookup joins (J1-J5) and orphans.

Spark decides how to join: it broadcasts a side whose files it knows to be
under ``spark.sql.autoBroadcastJoinThreshold`` and re-plans from measured
shuffle sizes.  A side derived in the same plan has no file size, and the
event side would be shuffled before its size is known.  ``stage=True`` therefore
computes such a side once (a checkpoint), sums the bytes of its rows, and hints
a broadcast if they are under the session's threshold.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.clean import q

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30}


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (negative: off)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


def row_bytes(df: DataFrame) -> F.Column:
    """Bytes of a row: 8 per field, and the bytes of its strings."""
    size = F.lit(8 * (len(df.columns) + 1))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(q(f.name)), F.lit(0))
    return size


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                stage: bool = False) -> DataFrame:
    """Join a (usually small) lookup side ``right`` to ``left``.

    ``stage=True`` for a right side that is derived rather than read from a
    table, see above.
    """
    if stage:
        right = right.checkpoint(eager=True)
        size = right.agg(F.coalesce(F.sum(row_bytes(right)), F.lit(0))).first()[0]
        if size <= broadcast_threshold(left.sparkSession):
            right = F.broadcast(right)
    return left.join(right, on, how)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row.  NULL keys are orphans.

    The missing keys are found among the fact's distinct keys (a partial
    aggregate on every task), so rows of a frequent key never meet the
    dimension; the fact is then filtered by that short list.
    """
    keys = fact.select(q(fact_key).alias("_key")).distinct()
    dims = dim.select(q(dim_key).alias("_dim_key")).distinct()
    lost = keys.join(dims, keys["_key"] == dims["_dim_key"], "left_anti")
    lost = lost.select(F.col("_key").alias("_lost"), F.lit(True).alias("_is_lost"))
    joined = lookup_join(fact, lost.where("_lost is not null"),
                         [q(fact_key).eqNullSafe(F.col("_lost"))], "left", stage=True)
    return joined.where(q(fact_key).isNull() | F.col("_is_lost")).drop("_lost", "_is_lost")
