"""History of a dimension (type 2): one row per version of a member, with the days
from which and before which it holds.

A snapshot of the dimension is compared with the open versions by a hash of the
attributes.  Members that are new or changed get an open version, changed and vanished
ones close theirs; a member that comes back later gets a version of its own, so
intervals of a key never overlap.

The table is partitioned by ``closed_on`` (9999-12-31: open).  A snapshot of day D
touches the open partition and the one of D, both written anew; closed history is
never read or written again.  The versions that were open before D follow from the
two, so a snapshot that is applied again leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.clean import q
from starmart.plans.incremental import existing_table
from starmart.sources.writers import delete_path

OPEN = "9999-12-31"


def attribute_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the values, each with its length, so that neighbours cannot run
    into one another; null differs from every value."""
    text = [q(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t),
                                        F.lit("-")) for t in text], F.lit("")), 256)


def next_versions(before: DataFrame, snapshot: DataFrame, keys: Sequence[str], day: Column) -> DataFrame:
    """``before`` (open versions: columns of ``snapshot``, valid_from, row_hash) and the
    snapshot of a day to all versions open then or closed by it, with ``closed_on``."""
    values = snapshot.columns
    names = [*values, "valid_from", "row_hash", "closed_on"]
    new = snapshot.withColumn("row_hash", attribute_hash([c for c in values if c not in keys]))
    old = before.select(*[q(c) for c in values], "valid_from", "row_hash")
    # One row per key and hash on either side: equal versions meet.
    same = F.col("o.row_hash") == F.col("n.row_hash")
    for k in keys:
        same = same & F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`"))
    marked = old.withColumn("_here", F.lit(True)).alias("o").join(
        new.withColumn("_there", F.lit(True)).alias("n"), same, "full")
    was, is_ = F.col("o._here").isNotNull(), F.col("n._there").isNotNull()
    return marked.select(
        *[F.when(was, F.col(f"o.`{c}`")).otherwise(F.col(f"n.`{c}`")).alias(c) for c in values],
        F.when(was, F.col("o.valid_from")).otherwise(day).alias("valid_from"),
        F.coalesce("o.row_hash", "n.row_hash").alias("row_hash"),
        F.when(was & ~is_, day).otherwise(F.lit(OPEN).cast("date")).alias("closed_on")).select(*names)


def update_history(spark: SparkSession, path: str, snapshot: DataFrame, keys: Sequence[str],
                   day: str) -> DataFrame:
    """Apply the snapshot of ``day`` (YYYY-MM-DD) to the history at ``path`` and return
    it.  ``keys`` must name one row of the snapshot each; null is a key.

    Days come in order: a day before one that has been applied raises.
    """
    on, still = F.lit(day).cast("date"), F.lit(OPEN).cast("date")
    history = existing_table(spark, path)
    closed_today = False
    if history is None:
        before = snapshot.limit(0).withColumns({"valid_from": on, "row_hash": F.lit("")})
    else:
        # The open versions, and of the closed ones only the partitions' names.
        days = history.groupBy("closed_on").agg(F.max(F.when(
            F.col("closed_on") == still, F.col("valid_from"))).alias("began"))
        last, closed_today = days.agg(
            F.max(F.when(F.col("closed_on") < still, F.col("closed_on")).otherwise(F.col("began"))),
            F.bool_or(F.col("closed_on") == on)).first()
        if last is not None and str(last) > day:
            raise ValueError(f"{day} lies before {last}, which has been applied")
        # Versions that began on the day go, those that it closed are open again (once,
        # also if a run broke off between the two partitions).
        before = (history.where(F.col("closed_on").isin(still, on) & (F.col("valid_from") < on))
                  .dropDuplicates([*keys, "valid_from", "row_hash"]))
    # Cut: the partitions that are read are about to be replaced.
    versions = next_versions(before, snapshot, keys, on).checkpoint(eager=True)
    (versions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("closed_on").parquet(path))
    written = {str(r[0]) for r in versions.select("closed_on").distinct().collect()}
    for gone, held in ((day, closed_today), (OPEN, history is not None)):
        if held and gone not in written:  # at most two partitions
            delete_path(spark, f"{path.rstrip('/')}/closed_on={gone}")
    return read_history(spark, path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions: the dimension's columns, valid_from, valid_to (the day from which
    it no longer holds; null while it does)."""
    h = spark.read.parquet(path)
    still = F.col("closed_on") == F.lit(OPEN).cast("date")
    return h.withColumn("valid_to", F.when(~still, F.col("closed_on"))).drop("closed_on", "row_hash")


def as_of(history: DataFrame, day: str) -> DataFrame:
    """The dimension as it was on a day."""
    on = F.lit(day).cast("date")
    return history.where((F.col("valid_from") <= on) & (F.col("valid_to").isNull()
                                                        | (F.col("valid_to") > on))).drop(
        "valid_from", "valid_to")
