"""Parquet sinks (K1, K2)."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite", max_records_per_file: int | None = None,
                spread_partitions: bool = False) -> str:
    """Write ``df`` as Parquet; ``partition_by`` gives a Hive layout.

    Dynamic-partition writes sort each task by the partition columns, so a
    task writes one file per partition it holds.  By default no shuffle on
    the partition columns is forced (one hot month of a fact table would land
    in one task).  ``spread_partitions`` hashes rows by the partition columns
    over ``spark.sql.shuffle.partitions`` tasks, so each directory is written
    by one task and the directories are written in parallel: for small
    tables with many partitions and no hot value, such as the calendar.
    """
    if partition_by and spread_partitions:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage for a table read by several later steps: they scan
    columnar files (pruned, filters pushed) instead of re-running the plan,
    and a lost executor costs nothing to recover.
    """
    from starmart.config import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on whatever Hadoop file system holds it.

    Returns False (and leaves the files) where the session has no JVM handle,
    as under Spark Connect.
    """
    try:
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True))
    except Exception as e:  # no SparkContext / JVM: keep going, files stay
        warnings.warn(f"could not delete staged data at {path}: {e}")
        return False


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage_table`` for the length of a block; the staged copy is deleted
    afterwards.  Nothing returned from the block may still read it."""
    from starmart.config import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        delete_path(spark, path)
