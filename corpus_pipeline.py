"""The corpus pipeline: five stages, each working on all that its predecessor
kept.  Every stage but the last returns the columns of documents.

    language           documents without a language, or without a clear one, go
    line_dedup         lines that stand earlier, up to one edit, go
    near_duplicates    of each group of near copies one document stays
    decontamination    documents that hold a benchmark item go
    mixing             sources are mixed to target weights, in training order

Columns that documents have besides their own pass through every stage, whatever
their names; the last stage replaces ``taken`` and ``position``.  Rows that repeat
one another are judged alike.  An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import scratch_path
from starmart.llm import decontam, langid, lines, mixing, simhash
from starmart.llm._util import table
from starmart.sources.writers import delete_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: learns from the labelled documents outside the held-out fold.
    Null texts and texts without a letter have no language and go."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_identified(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: copied lines leave the texts, n_chars follows them.  Of copies the
    one of smallest doc_id and line stays; documents without a doc_id stay whole."""
    out = lines.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(
        *docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: 4-word shingles, at most 4 differing bits; the smallest doc_id of a
    group stays.  Texts without words, null ones too, are copies of one another;
    documents without a doc_id stay."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: against all benchmark items; null and empty texts hold none."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row per pass over a document that the mix takes, with
    the document's columns, ``taken`` (its words in the mix) and ``position``.
    Texts without words, null ones too, are not taken."""
    return mixing.training_stream(docs, taken="taken", position="position")


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mix)]

#: Naive Bayes, iterated components and templates have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again; a copy is
    deleted when the next one is written.  The last one stays, as the result reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"{name}.parquet")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = table(spark, path.rpartition("/")[0], name), path
    return STAGES[-1][1](spark, docs, sf_dir)
