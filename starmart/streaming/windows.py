"""Windowed counts of a stream, kept up to date in a table.

The state store holds the open windows; in update mode each batch emits the windows
it changed, with their whole counts.  ``upsert`` replaces those rows in the table.
As a batch brings totals, not increments, and a row remembers the batch it came
from, a batch that is run again, now or after later ones, leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.functions.dates import sas_date
from starmart.operators.clean import q
from starmart.plans.incremental import existing_table

BATCH = "batch"


def upsert(rows: DataFrame, batch_id: int, table: str, keys: Sequence[str],
           partition_by: str) -> None:
    """Put ``rows`` (one per ``keys``) into ``table``: they replace rows of the same
    keys of the same or an earlier batch.  Only the partitions of ``partition_by``
    that the batch touches are read and written again."""
    spark = rows.sparkSession
    rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
    old = existing_table(spark, table)
    if old is not None:
        touched = rows.select(q(partition_by).alias("_p")).distinct()
        old = old.join(touched, q(partition_by).eqNullSafe(F.col("_p")), "left_semi")
        rows = old.select(*rows.columns).union(rows)
    order = F.struct(BATCH, *[q(c) for c in rows.columns if c != BATCH and c not in keys])
    newest = rows.groupBy(*[q(k) for k in keys]).agg(F.max(order).alias("_row"))
    merged = newest.select(*[q(c) if c in keys else F.col(f"_row.`{c}`") for c in rows.columns])
    # Cut: the partitions that are read are about to be replaced.
    merged = merged.checkpoint(eager=True)
    if not merged.isEmpty():
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by).parquet(table))


def weekly_arrivals(events: DataFrame, delay: str) -> DataFrame:
    """Arrivals per week (from Monday on) and state, of a stream or a table of
    cleaned events.  Rows without an arrival date are in no week."""
    day = events.select(sas_date("arrdate").cast("timestamp").alias("arrival"),
                        F.col("i94addr").alias("state_code"))
    # Weeks of the epoch begin on a Thursday; Monday is four days later.
    week = F.window("arrival", "7 days", startTime="4 days")
    return (day.withWatermark("arrival", delay).groupBy(week, "state_code")
            .agg(F.count(F.lit(1)).alias("arrivals"))
            .select(F.to_date("window.start").alias("week"), "state_code", "arrivals",
                    F.year(F.to_date("window.start")).alias("year")))


def stream_weekly_arrivals(spark: SparkSession, landing: str, table: str, schema: T.StructType,
                           delay: str = "60 days", fmt: str = "parquet",
                           available_now: bool = True) -> StreamingQuery:
    """Keep the weekly arrivals per state of the cleaned events under ``landing`` in
    ``table``, partitioned by the year in which the week begins."""
    events = spark.readStream.format(fmt).schema(schema).load(landing)
    writer = (weekly_arrivals(events, delay).writeStream.outputMode("update")
              .foreachBatch(lambda rows, i: upsert(rows, i, table, ["week", "state_code", "year"], "year"))
              .option("checkpointLocation", f"{table.rstrip('/')}/_checkpoints/weekly_arrivals"))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime="1 minute")).start()
