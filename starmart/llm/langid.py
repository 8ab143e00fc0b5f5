"""Language identification (operator 6).

Multinomial naive Bayes over hashed character n-grams.  A text becomes its
lower-cased letters with every run of other characters as one space; its 1- to
3-grams are hashed into ``2**bits`` buckets.

Texts are read in pieces of ``PIECE`` characters, and pieces of many texts are
counted together into sparse (text, bucket, count) entries, so memory does not
follow a text's length.  Training adds the entries up per language, in Spark
tasks, over a bounded sample of labelled documents (whole texts).  Scoring
multiplies a batch's entries with the log-probability matrix (buckets x
languages, independent of the corpus size), which is broadcast.

The sample is drawn per language by a hash of the document, so reruns agree, a
language with fewer documents than the bound is learned from all of them, and
copies of one text are drawn one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import map_texts, slices

BITS = 15
GRAMS = 3
#: Bound of the training sample, in documents of each language.  It is drawn with
#: equal chance from the language's documents that are not held out.
SAMPLE_DOCS = 5_000
UNKNOWN = "und"
#: Characters of a text that are read at once, and of texts counted together.
PIECE = 1 << 17
GROUP = 1 << 18
_MULT = np.uint32(0x9E3779B1)
_LETTER = regex.compile(r"\p{L}")
#: Marks and letters stay, everything else separates words.
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """(characters, how many of them the piece before has counted) of the normalised
    text, which starts and ends with a space.  A piece repeats the last GRAMS - 1
    characters, so every n-gram ends in the new ones of exactly one piece."""
    tail, old = " ", 0
    for start in range(0, max(len(text), 1), PIECE):
        # One form of sigma: the only letter whose lower case depends on what follows.
        kept = _OTHER.sub(" ", text[start:start + PIECE].lower().replace("ς", "σ"))
        if tail[-1] == " ":
            kept = kept.removeprefix(" ")
        if start + PIECE >= len(text) and (tail + kept)[-1] != " ":
            kept += " "
        if kept or not old:
            yield tail + kept, old
            tail = (tail + kept)[-(GRAMS - 1):]
            old = len(tail)


def _entries(pieces: list[tuple[int, str, int]], bits: int) -> tuple[np.ndarray, ...]:
    """Sparse counts of pieces (text number, characters, counted before): the text number
    and the first entry of each piece, then the buckets and counts of the entries."""
    c = np.frombuffer("".join(p[1] for p in pieces).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.array([len(p[1]) for p in pieces])
    kind = np.uint32 if len(pieces) << bits <= 1 << 32 else np.uint64
    piece = np.repeat(np.arange(len(pieces), dtype=kind), sizes)
    first = np.cumsum(sizes) - sizes
    fresh = np.ones(len(c), bool)
    for i, (_, _, old) in enumerate(pieces):
        if old:
            fresh[first[i]:first[i] + old] = False
    h, shift, keys = np.zeros(len(c), np.uint32), np.uint32(32 - bits), []
    for n in range(GRAMS):
        m = len(c) - n
        if m <= 0:
            break
        h = (h[:m] + c[n:] + np.uint32(n + 1)) * _MULT
        h ^= h >> np.uint32(15)
        own = fresh[n:] & (piece[:m] == piece[n:])
        keys.append((piece[:m] << kind(bits) | ((h * _MULT) >> shift))[own])
    key = np.sort(np.concatenate(keys))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    starts = np.searchsorted(key, np.arange(len(pieces), dtype=kind) << kind(bits))
    return (np.array([p[0] for p in pieces]), starts,
            (key & kind((1 << bits) - 1)).astype(np.int64), count)


def _counted(texts: Iterable[str | None], bits: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``_entries`` of the texts, in groups of about GROUP characters.  Texts without a
    letter have none."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if not t or not _LETTER.search(t):
            continue
        for chars, old in _pieces(t):
            held.append((i, chars, old))
            size += len(chars)
            if size >= GROUP:
                yield _entries(held, bits)
                held, size = [], 0
    if held:
        yield _entries(held, bits)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, bits: int = BITS) -> dict:
    """Model of the documents of ``labelled`` with a text and a label.

    ``{"langs": [...], "logp": float64 matrix of languages x 2**bits,
    "prior": float64 vector}``; no languages when nothing is labelled.  About
    ``sample_docs`` documents a language at most are read for the n-gram counts,
    which are summed in tasks; priors come from all of them.  The driver receives
    one row of counts per language.
    """
    rows = labelled.select(F.col(f"`{text_col}`").cast("string").alias("_text"),
                           F.col(f"`{lang_col}`").cast("string").alias("_lang"),
                           F.col(f"`{id_col}`").alias("_id"))
    rows = rows.where("_text is not null and _lang is not null and _text rlike '\\\\p{L}'")
    # One row per language, like the model itself.
    docs = {r["_lang"]: r["n"] for r in
            rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs, size = sorted(docs), 1 << bits
    # The smallest hashes: a uniform sample that any rerun draws again.  The
    # threshold comes from the count, so no task ever sorts all rows.
    shares = [x for lang, n in docs.items() if n > sample_docs
              for x in (F.lit(lang), F.lit(sample_docs / n))]
    if shares:
        place = F.pmod(F.xxhash64("_id", "_text", "_lang"), F.lit(1 << 30)) / F.lit(1 << 30)
        rows = rows.where(place < F.coalesce(F.create_map(*shares)[F.col("_lang")], F.lit(1.0)))
    number = {lang: j for j, lang in enumerate(langs)}

    def count(batches):
        total: dict[int, np.ndarray] = {}
        for b in slices(batches, "_text"):
            lang = np.array([number[x] for x in b.column("_lang").to_pylist()])
            for text, starts, bucket, n in _counted(b.column("_text").to_pylist(), bits):
                of = np.repeat(lang[text], np.diff(np.append(starts, len(n))))
                for j in np.unique(of):
                    mine = of == j
                    total[j] = total.get(j, 0) + np.bincount(bucket[mine], n[mine], size)
        for j, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), j, np.int32)), pa.array(at),
                 pa.array(c[at].astype(np.int64))], names=["lang", "bucket", "n"])

    sums = (rows.select("_text", "_lang").mapInArrow(count, "lang int, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # One row per language, each at most 2**bits counts.
    got = sums.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    counts = np.zeros((len(langs), size))
    for r in got.toLocalIterator():
        counts[r["lang"], r["b"]] = r["n"]
    smooth = counts + 0.1
    all_docs = np.array([docs[lang] for lang in langs], np.float64)
    return {"langs": langs, "bits": bits, "prior": np.log(all_docs / max(all_docs.sum(), 1)),
            "logp": np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))}


def score_texts(texts: list[str | None], model: dict) -> list[tuple[str, float]]:
    """(language, posterior) of each text: sparse counts times the matrix."""
    langs, known = model["langs"], np.zeros(len(texts), bool)
    s = np.zeros((len(langs), len(texts)))
    for text, starts, bucket, n in _counted(texts, model["bits"]) if langs else ():
        known[text] = True
        for j in range(len(langs)):  # pieces are added in their order, so reruns agree
            np.add.at(s[j], text, np.add.reduceat(model["logp"][j][bucket] * n, starts))
    if not known.any():
        return [(UNKNOWN, 0.0)] * len(texts)
    s += model["prior"][:, None]
    best = s.argmax(axis=0)
    post = 1.0 / np.exp(np.minimum(s - s.max(axis=0), 0)).sum(axis=0)
    return [(langs[j], p) if k else (UNKNOWN, 0.0)
            for j, p, k in zip(best, post.tolist(), known)]


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``; score is the posterior.

    ``und`` with score 0 when the text is null, has no letter, or the model
    knows no language.  Whole texts are scored; ties go to the language first
    in order; repeated rows give repeated results; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                    F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = score_texts(b.column("_text").to_pylist(), held.value)
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
             pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])
    return map_texts(d, run, "doc_id long, lang_pred string, score double", "_text")


def held_out(doc_id) -> F.Column:
    """The fold that training never reads: crc32(doc_id as text) mod 4 = 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, model: dict, min_score: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text has no language or no clear one.

    Null and empty texts and texts without a letter go.  Rows are judged one by one,
    so repeated rows are judged alike, the columns of ``docs`` pass unchanged, rows
    without a doc_id are judged like any other, and an empty table stays empty.
    """
    held, names, schema = docs.sparkSession.sparkContext.broadcast(model), docs.columns, docs.schema

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = score_texts(b.column("text").to_pylist(), held.value)
        return b.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in got]))
    return map_texts(docs.select(*[F.col(f"`{c}`") for c in names]), run, schema, "text")
