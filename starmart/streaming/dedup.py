"""Streams with repeated and late events: every row that lands is kept, a repeat,
or late, and none disappears unaccounted for.

Spark's stateful operators drop late rows without a trace.  So two streams follow
each other:

1. ``split_late`` divides each batch by its watermark: the greatest event time of all
   batches before it, less ``delay``.  Rows at or before it, and rows without an event
   time, go to the table ``late``, the others to ``on_time``.  A batch writes folders
   of its own number, so a batch that is run again replaces what it wrote;
2. ``keep_first`` reads ``on_time`` as a stream and drops repeats of (keys, event
   time) with the state store, within the same delay.  Its watermark follows the rows
   it has read, so it is never ahead of the first one, and no row is late there.  A
   repeat has the event time of its original: as long as it is on time, so is the
   state of the original.

What the state store holds is bounded by the keys of one delay, whatever the length of
the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.operators.clean import q
from starmart.plans.incremental import existing_table

BATCH = "batch"


def split_batch(batch: DataFrame, batch_id: int, table: str, time_col: str, delay: str) -> None:
    """Write the rows of one batch to ``on_time`` and ``late``, and its greatest
    event time to ``clock``."""
    spark = batch.sparkSession
    clock = existing_table(spark, f"{table}/clock")
    before = None
    if clock is not None:
        before = clock.where(F.col(BATCH) < batch_id).agg(F.max("time")).first()[0]
    mark = F.lit(before).cast(batch.schema[time_col].dataType) - F.expr(f"INTERVAL {delay}")
    late = q(time_col).isNull() | F.coalesce(q(time_col) <= mark, F.lit(False))
    for name, rows in (("on_time", batch.where(~late)), ("late", batch.where(late)),
                       ("clock", batch.agg(F.max(q(time_col)).alias("time")))):
        rows.write.mode("overwrite").parquet(f"{table}/{name}/{BATCH}={batch_id}")


def split_late(spark: SparkSession, landing: str, table: str, schema: T.StructType, time_col: str,
               delay: str, fmt: str = "parquet", available_now: bool = True,
               max_files_per_trigger: int | None = None) -> StreamingQuery:
    """First stream: ``landing`` to the tables ``on_time`` and ``late`` under ``table``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.load(landing).writeStream
              .foreachBatch(lambda batch, i: split_batch(batch, i, table, time_col, delay))
              .option("checkpointLocation", f"{table}/_checkpoints/split_late"))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime="1 minute")).start()


def keep_first(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str],
               time_col: str, delay: str, available_now: bool = True) -> StreamingQuery:
    """Second stream: ``on_time`` to the table ``kept``, one row per keys and time."""
    rows = (spark.readStream.schema(schema).option("recursiveFileLookup", True)
            .parquet(f"{table}/on_time"))
    # Watermarks want a time with zone, which the events may lack.
    kept = (rows.withColumn("_time", q(time_col).cast("timestamp")).withWatermark("_time", delay)
            .dropDuplicatesWithinWatermark([*keys, "_time"]).drop("_time"))
    writer = (kept.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", f"{table}/_checkpoints/keep_first")
              .option("path", f"{table}/kept"))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime="1 minute")).start()


def ingest_events(spark: SparkSession, landing: str, table: str, schema: T.StructType,
                  keys: Sequence[str], time_col: str, delay: str) -> None:
    """One run over what has landed: both streams, one after the other."""
    split_late(spark, landing, table, schema, time_col, delay).awaitTermination()
    keep_first(spark, table, schema, keys, time_col, delay).awaitTermination()


def outcomes(spark: SparkSession, table: str, keys: Sequence[str], time_col: str) -> DataFrame:
    """keys, event time, outcome (``kept``, ``repeated`` or ``late``) and n, the rows
    that met it; the sum of n is the number of rows that landed."""
    by = [*keys, time_col]
    count = F.count(F.lit(1)).alias("n")
    read = lambda name: spark.read.parquet(f"{table}/{name}").groupBy(
        *[q(c) for c in by]).agg(count)
    kept, on_time, late = read("kept"), read("on_time"), read("late")
    first = kept.select(*[q(c).alias(f"_{i}") for i, c in enumerate(by)], F.col("n").alias("_n"))
    same = [q(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(by)]
    repeated = (on_time.join(first, same, "left")
                .select(*[q(c) for c in by], (F.col("n") - F.coalesce("_n", F.lit(0))).alias("n"))
                .where("n <> 0"))
    parts = [d.select(*[q(c) for c in by], F.lit(name).alias("outcome"), "n")
             for name, d in (("kept", kept), ("repeated", repeated), ("late", late))]
    return parts[0].union(parts[1]).union(parts[2])
