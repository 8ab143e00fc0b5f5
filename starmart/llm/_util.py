"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of several contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a few numbers that make one checkpoint file when a count is known.
CUT_ROWS = 200_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    With a known bound of ``rows`` the number of files follows it, so a small
    table does not become a file per shuffle partition.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // CUT_ROWS)))
    return df.checkpoint(eager=True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also fold other scripts)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], text: str,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds about ``max_bytes`` of ``text``.

    Documents differ in length by orders of magnitude; a batch bounded by rows
    alone could hold gigabytes.  A single longer row makes a batch of its own.
    """
    for batch in batches:
        column, start, held = batch.column(text), 0, 0
        for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
            if held and held + (n or 0) > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
              text: str) -> DataFrame:
    """``mapInArrow`` over byte-bounded batches; ``fn`` maps one batch to one."""
    def run(batches):
        for b in slices(batches, text):
            out = fn(b)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


#: ASCII letters to lower case, as a table for ``bytes.translate``.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACES = re.compile(rb"[\x20\x09-\x0D]+")
