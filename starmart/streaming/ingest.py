"""Daily ingestion of arrival files as a Structured Streaming job.

The star is rebuilt in batch; what changes every day is the event input.
New files dropped into a landing folder are picked up exactly once (the
file source remembers what it read in the checkpoint), cleaned with the
same stateless steps as the batch pipeline (sparse columns dropped, all-empty
rows removed) and appended to a Parquet table through the exactly-once file
sink.  ``trigger(availableNow=True)`` processes what has landed and stops, so
a scheduler can start the job once a day; without it the query keeps running.

The checkpoint belongs to the table, not to the application: by default it
lives inside the table's folder, so tomorrow's run, a new application, goes on
where today's stopped, and two tables never share one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.operators.clean import clean_arrivals


def default_checkpoint(table: str) -> str:
    """Beside the table's files, under a name that readers of the table skip."""
    return f"{table.rstrip('/')}/_checkpoints/ingest_arrivals"


def ingest_arrivals(spark: SparkSession, landing: str, table: str, schema: T.StructType,
                    fmt: str = "parquet", checkpoint: str | None = None,
                    available_now: bool = True, max_files_per_trigger: int | None = None,
                    **options) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` it)."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cleaned = clean_arrivals(reader.load(landing))
    writer = (cleaned.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or default_checkpoint(table))
              .option("path", table))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
