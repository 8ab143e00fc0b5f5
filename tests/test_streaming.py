"""Streaming ingestion: files landed in two drops are each ingested exactly once."""

from pyspark.sql import functions as F

from starmart.config import scratch_path
from starmart.sources import bindings as B
from starmart.operators.clean import clean_arrivals
from starmart.streaming import ingest_arrivals


def test_two_daily_drops_ingested_once(spark):
    """Two days, as two applications run them: each sets the checkpoint folder
    anew, and the stream still goes on where it stopped."""
    arrivals = B.arrivals(spark, "/root/testdata/sf0.001")
    kept = clean_arrivals(arrivals).count()
    landing, *tables = (scratch_path(spark, n) for n in ("landing", "table_a", "table_b"))
    base = spark.sparkContext.getCheckpointDir()
    for drop in (F.coalesce(F.col("i94mon") <= 6, F.lit(True)), F.col("i94mon") > 6):
        arrivals.where(drop).write.mode("append").parquet(landing)
        spark.sparkContext.setCheckpointDir(base)  # a new random folder under it
        for table in tables:
            ingest_arrivals(spark, landing, table, arrivals.schema).awaitTermination()
    for table in tables:
        out = spark.read.parquet(table)
        assert out.count() == kept < arrivals.count()
        assert "occup" not in out.columns
        assert sorted(map(str, out.collect())) == sorted(map(str, clean_arrivals(arrivals).collect()))
