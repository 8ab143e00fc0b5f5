"""One query per operator over its whole table, with production parameters,
and the DuckDB twin of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import scratch_path
from starmart.llm import (decontam, divergence, embeddings, html_text, langid, licenses, lines, mixing,
                          repeats, runs, secrets, simhash, token_file)
from starmart.llm._util import WORD, table
from starmart.sources.writers import delete_path


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document: 4-word shingles,
    4 bits; ``kept`` marks the document of each group that stays."""
    out = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", "fingerprint", "component_id",
                      (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents")
    fold = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~fold))
    return langid.identify(docs, model).select("doc_id", fold.alias("held_out"), "lang_pred",
                                               "score")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and the
    training position of its first pass (null when the mix takes nothing)."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken",
                        F.round(F.get("positions", F.lit(0)), 6).alias("position"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the license detections of every document."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the secrets of every document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    out = html_text.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_exact, n_near and the dropped line numbers of every document."""
    return lines.line_report(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector: cosine of 0.9 or more."""
    out = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op7_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document:
    bytes of 200-byte strings that also start elsewhere go."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the periodic runs of every document.  Every tenth document (by
    the CRC of its id) is made periodic from a word on first, as its contract says."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    d = docs.withColumns({"h": h, "words": F.when(h % 10 == 0, F.regexp_extract_all(
        F.col("text"), F.lit(WORD), F.lit(0)))})
    d = d.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)}).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    copies = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    periodic = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(
        F.slice("words", F.col("a") + 1, F.col("p")), copies))), F.lit(1), F.col("n"))
    text = F.when(F.col("a").isNotNull(), F.array_join(periodic, " ")).otherwise(F.col("text"))
    return runs.digest(runs.periodic_runs(d.select("doc_id", text.alias("text"))))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the
    written shards (which are then deleted)."""
    import public_tokenizers
    path = scratch_path(spark, "tokens")
    out = token_file.encode_and_index(table(spark, sf_dir, "documents"), path,
                                      public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    delete_path(spark, path)
    return out


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, source, part, item, value, rank: prices of every source against the
    others of its language and its ten most raised terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_embedding_near_dedup, op3_license_scan, op4_simhash_near_dedup, op5_html_extraction, op6_language_id,
    op7_repeat_removal, op8_mix_sources, op9_secret_scan, op10_benchmark_decontamination,
    op11_periodic_runs, op12_token_ids, op13_source_divergence)}
ORACLE: dict[str, str] = {
    "op1_line_dedup": lines.oracle_sql(),
    "op8_mix_sources": mixing.ORACLE,
    "op9_secret_scan": secrets.oracle_sql(),
    "op13_source_divergence": divergence.ORACLE}
