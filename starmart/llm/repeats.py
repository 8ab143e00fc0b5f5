"""Removal of repeated byte strings by merged suffix orders (operator 7).

A byte goes when some string of ``length`` bytes that covers it also starts
anywhere else, in the same text or another.

Sampling suffixes: every string of ``length`` bytes holds an anchor, the k-gram
of smallest hash among all its k-grams (leftmost on ties).  Equal strings have
equal anchors at equal places, so a string can repeat only if its anchor does,
and only beside that anchor.  Texts are scanned once for anchors; only the
neighbourhoods (contexts) of anchors that occur twice go on, and equal contexts
are merged into one with a count.

Merging shards: contexts of the same anchors meet in one task.  Each shard of
contexts is sorted by the suffix that begins at the anchor, and so is what
precedes it, read backwards (the symbols of the shard's transform).  Two shards
are merged by refining their interleave: all suffixes start in one block, and
each round splits blocks by the next eight bytes of both sorted lists until
they are apart, which yields the merged order and its common prefixes without
sorting suffixes again.  Suffixes whose common prefix is long enough, and which
are preceded by the same bytes, are repeated intervals.

An anchor that occurs more than ``_OPEN`` times is not gathered in one task: the
strings of its different contexts are counted by their hashes.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import cut, slices
from starmart.operators.joins import lookup_join
from starmart.sources.writers import delete_path

LENGTH = 200
GRAM = 32
#: Bytes scanned at a time, contexts merged at a time, contexts of a shard, and
#: the most occurrences of an anchor that one task gathers.
_PIECE = 1 << 19
_MERGE = 16384
_SHARD = 4096
_OPEN = 65536
#: Low bits of a text's hash in the prefilters; at most 2**20 numbers are broadcast.
_FILTER = (1 << 20) - 1


# ------------------------------------------------------------------------ anchors

@lru_cache(maxsize=2)
def _powers(n: int):
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every k-gram, from running sums of a polynomial."""
    up, down = _powers(1 << (len(x) - 1).bit_length())
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[:len(x)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:len(x) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash in every run of ``width``, leftmost on ties."""
    # Compared by the upper 44 bits, then by place; pieces are below 2**20.
    packed = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
    n = len(h)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    full[:n] = packed
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n - width + 1], ahead[width - 1:n])
    return (low & np.uint64((1 << 20) - 1)).astype(np.int64)


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Anchors of the strings of ``length`` bytes of some texts, as arrays
    (text number, hash, place, first string, last string); the last three are
    byte offsets in the text."""
    out = []
    for group, offset in _pieces(texts, length):
        sizes = np.array([len(t) for _, t in group])
        x = np.frombuffer(b"".join(t for _, t in group), np.uint8)
        if len(x) < length:
            continue
        h = _gram_hashes(x, gram)
        at = _leftmost_minima(h, length - gram + 1)
        text = np.repeat(np.arange(len(group)), sizes)
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        ok = np.nonzero(text[:len(x) - length + 1] == text[length - 1:])[0]
        if not len(ok):
            continue
        at, owner = at[ok], text[ok]
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
        first = np.nonzero(new)[0]
        last = np.concatenate([first[1:], [len(ok)]]) - 1
        base = start[ok[first]] - offset
        number = np.array([i for i, _ in group])[owner[first]]
        out.append((number, h[at[first]].view(np.int64), at[first] - base, ok[first] - base,
                    ok[last] - base))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


def _pieces(texts, length):
    """Texts joined up to the piece size; a longer text is cut into pieces that
    overlap, so that each of its strings lies in exactly one."""
    group, held = [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        if len(t) > _PIECE:
            for s in range(0, len(t) - length + 1, _PIECE):
                yield [(i, t[s:s + _PIECE + length - 1])], s
            continue
        if held + len(t) > _PIECE and group:
            yield group, 0
            group, held = [], 0
        group.append((i, t))
        held += len(t)
    if group:
        yield group, 0


# ----------------------------------------------------------- merged suffix orders

def _interleave(words: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Merge two sorted lists of rows of ``words``: (order, common prefix in
    bytes of each row with the one before), by refining their interleave."""
    n = len(a) + len(b)
    block_a, block_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    place_a, place_b = np.arange(len(a)), len(a) + np.arange(len(b))
    prefix = np.full(n, 8 * words.shape[1], np.int64)
    prefix[0] = 0
    apart = np.zeros(n, bool)
    apart[0] = True
    for h in range(words.shape[1]):
        wa, wb = words[a, h], words[b, h]
        values = np.unique(np.concatenate([wa, wb]))
        key_a = block_a * len(values) + np.searchsorted(values, wa)
        key_b = block_b * len(values) + np.searchsorted(values, wb)
        place_a = np.arange(len(a)) + np.searchsorted(key_b, key_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(key_a, key_b, "right")
        key, word = np.empty(n, np.int64), np.empty(n, np.uint64)
        key[place_a], key[place_b] = key_a, key_b
        word[place_a], word[place_b] = wa, wb
        new = np.concatenate([[True], key[1:] != key[:-1]])
        split = np.nonzero(new & ~apart)[0]
        differ = word[split] ^ word[split - 1]
        prefix[split] = 8 * h + _leading_equal(differ)
        apart |= new
        block = np.cumsum(new) - 1
        block_a, block_b = block[place_a], block[place_b]
        if apart.all():
            break
    order = np.empty(n, np.int64)
    order[place_a], order[place_b] = a, b
    return order, prefix


def _leading_equal(differ: np.ndarray) -> np.ndarray:
    """Number of leading zero bytes of each word."""
    out = np.zeros(len(differ), np.int64)
    for k in range(1, 8):
        out += differ < np.uint64(1 << (64 - 8 * k))
    return out


def merged_order(rows: np.ndarray, shard: int = _SHARD):
    """(order, common prefix) of equally long byte rows: shards are sorted, then
    merged pairwise.  The prefix of the first row is 0."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = np.ascontiguousarray(padded).view(">u8").astype(np.uint64)
    keys = np.ascontiguousarray(padded).view(f"S{padded.shape[1]}").ravel()
    lists = [s + np.argsort(keys[s:s + shard], kind="stable") for s in range(0, n, shard)]
    empty, prefix = np.zeros(0, np.int64), None
    while len(lists) > 1:
        merged = []
        for i in range(0, len(lists), 2):
            if i + 1 < len(lists):
                order, prefix = _interleave(words, lists[i], lists[i + 1])
                merged.append(order)
            else:
                merged.append(lists[i])
        lists = merged
    if prefix is None:
        lists[0], prefix = _interleave(words, lists[0], empty)
    return lists[0], prefix


def repeated_starts(group: np.ndarray, contexts: list[bytes], at: np.ndarray, many: np.ndarray,
                    length: int = LENGTH, shard: int = _SHARD) -> np.ndarray:
    """Flags (context, start) of the strings of ``length`` bytes that stand in
    another context of the same group at the same place beside the anchor, or
    in a context with ``many``."""
    n = len(contexts)
    size = np.array([len(c) for c in contexts])
    starts = int((size - length).max()) + 1
    flags = np.zeros((n, starts), bool)
    flags[many] = True
    name = np.ascontiguousarray(group.astype(">u4")).view(np.uint8).reshape(n, 4)

    def classes(parts, width):
        rows = np.zeros((n, 8 + width), np.uint8)
        rows[:, 4:8] = name
        for i, p in enumerate(parts):
            rows[i, 8:8 + len(p)] = np.frombuffer(p, np.uint8)
        order, prefix = merged_order(rows, shard)
        prefix[0] = 0

        def of(k: int) -> np.ndarray:
            """Number of the class of equal first ``k`` bytes, per context."""
            out = np.empty(n, np.int64)
            out[order] = np.cumsum(prefix < 8 + k)
            return out
        return of
    right = classes([c[i:i + length] for c, i in zip(contexts, at)], length)
    before = int(at.max())
    left = classes([c[:i][::-1] for c, i in zip(contexts, at)], before)
    for back in range(before + 1):  # strings that start ``back`` bytes before the anchor
        s = at - back
        ok = np.nonzero((s >= 0) & (s <= size - length))[0]
        if len(ok) < 2:
            continue
        key = left(back)[ok] * (n + 1) + right(length - back)[ok]
        _, number, count = np.unique(key, return_inverse=True, return_counts=True)
        again = ok[count[number] > 1]
        flags[again, s[again]] = True
    flags &= np.arange(starts)[None, :] <= (size - length)[:, None]
    return flags


def _runs(flags: np.ndarray):
    """(row, first, last) of the runs of set flags in each row."""
    wide = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    wide[:, 1:-1] = flags
    step = np.diff(wide, axis=1)
    row, first = np.nonzero(step == 1)
    _, last = np.nonzero(step == -1)
    return row, first, last - 1


# --------------------------------------------------------------------- Spark steps

def _resolve(length: int):
    """Rows (h, c1, c2, n, at, context), sorted by h, to runs of repeated starts
    (c1, c2, s, e).  Whole groups are merged, about ``_MERGE`` contexts at a time."""
    def flush(held):
        h = np.array([r[0] for r in held], np.int64)
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        flags = repeated_starts(group, [r[5] for r in held], np.array([r[4] for r in held]),
                                np.array([r[3] > 1 for r in held]), length)
        row, first, last = _runs(flags)
        c1, c2 = (np.array([r[i] for r in held], np.int64)[row] for i in (1, 2))
        return pa.RecordBatch.from_arrays(
            [pa.array(c1), pa.array(c2), pa.array(first.astype(np.int32)),
             pa.array(last.astype(np.int32))], names=["c1", "c2", "s", "e"])

    def run(batches):
        held: list[tuple] = []
        for b in batches:
            for r in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if len(held) >= _MERGE and r[0] != held[-1][0]:
                    yield flush(held)
                    held = []
                held.append(r)
        if held:
            yield flush(held)
    return run


def _by_hash(open_: DataFrame, length: int) -> DataFrame:
    """Runs (c1, c2, runs) of contexts too many to gather, by counting hashes: one
    row per context, its consecutive repeated starts folded to runs."""
    each = open_.select("h", "c1", "c2", "at", "context", F.explode(F.sequence(
        F.lit(0), F.length("context") - length)).alias("s"))
    string = F.substring("context", F.col("s") + 1, F.lit(length))
    each = each.select("h", "c1", "c2", "s", (F.col("at") - F.col("s")).alias("back"),
                       F.xxhash64(string).alias("x"), F.xxhash64(F.lit(1), string).alias("y"))
    keys = ["h", "back", "x", "y"]
    again = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # At most a context's length of starts in an array.
    starts = (each.join(again, keys, "left_semi").groupBy("c1", "c2")
              .agg(F.array_sort(F.collect_set("s")).alias("starts")))
    edge = lambda step: F.filter("starts", lambda s: ~F.array_contains(
        F.col("starts"), s + step))
    return starts.select("c1", "c2", F.arrays_zip(edge(-1).alias("s"), edge(1).alias("e"))
                         .cast("array<struct<s:int,e:int>>").alias("runs"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(t1, t2, text) once per wanted text: a bounded prefilter on a few bits of
    the hash spares other texts the shuffle, the join after it decides."""
    bits = wanted.select(F.col("t1").bitwiseAND(F.lit(_FILTER)).alias("_bits")).distinct()
    likely = docs.join(F.broadcast(bits), F.col("t1").bitwiseAND(F.lit(_FILTER)) == F.col("_bits"),
                       "left_semi")
    return likely.groupBy("t1", "t2").agg(F.first("text").alias("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(t1, t2, spans) of the texts that hold strings standing elsewhere in
    other places of different texts; ``docs`` has t1, t2 (hashes of the text)
    and text (binary).  Spans are (start, end) arrays that may overlap."""
    if not 1 <= gram <= length:
        raise ValueError("gram must lie between 1 and length")
    from starmart.config import scratch_path
    spark = docs.sparkSession

    def scan(batches):
        for b in slices(batches, "text", _PIECE):
            got = anchors(b.column("text").to_pylist(), length, gram)
            if len(got[0]):
                t1, t2 = (b.column(c).to_numpy()[got[0]] for c in ("t1", "t2"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[1]), pa.array(t1), pa.array(t2),
                     *[pa.array(c.astype(np.int32)) for c in got[2:]]],
                    names=["h", "t1", "t2", "a", "lo", "hi"])
    path = scratch_path(spark, "anchors")
    (docs.where(F.octet_length("text") >= length).select("t1", "t2", "text")
     .mapInArrow(scan, "h long, t1 long, t2 long, a int, lo int, hi int").write.parquet(path))
    found = spark.read.parquet(path)
    # Anchors in two places; the same place of equal texts is one place.
    place = F.xxhash64("t1", "t2", "a")
    twice = cut(found.groupBy("h").agg(F.min(place).alias("p"), F.max(place).alias("q"))
                .where("p <> q").select(F.col("h").alias("_h")))
    per_text = cut(found.join(twice, F.col("h") == F.col("_h")).groupBy("t1", "t2").agg(
        F.collect_set(F.struct("h", "a", "lo", "hi")).alias("anchors"))
        .withColumnsRenamed({"t1": "_t1", "t2": "_t2"}))
    delete_path(spark, path)

    def contexts(batches):
        for b in slices(batches, "text"):
            rows = [(x["h"], t1, t2, x["lo"], x["a"] - x["lo"], t[x["lo"]:x["hi"] + length])
                    for t1, t2, t, xs in zip(*[b.column(c).to_pylist()
                                               for c in ("t1", "t2", "text", "anchors")]) for x in xs]
            for s in range(0, len(rows), 20_000):
                cols = list(zip(*rows[s:s + 20_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(cols, (
                        pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["h", "t1", "t2", "lo", "at", "context"])
    wanted = per_text.select(F.col("_t1").alias("t1"))
    seen = (_texts(docs, wanted).join(per_text, (F.col("t1") == F.col("_t1"))
                                      & (F.col("t2") == F.col("_t2")))
            .select("t1", "t2", "text", "anchors")
            .mapInArrow(contexts, "h long, t1 long, t2 long, lo int, at int, context binary")
            .withColumn("c1", F.xxhash64("h", "at", "context"))
            .withColumn("c2", F.xxhash64("context", "at", F.lit(1))))
    path = scratch_path(spark, "contexts")
    seen.write.parquet(path)
    seen = spark.read.parquet(path)
    different = seen.groupBy("h", "c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.first("at").alias("at"),
        F.first("context").alias("context"))
    frequent = cut(seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _OPEN)
                   .select("h"))
    gathered, runs = different, None
    if not frequent.isEmpty():
        # A short list (an _OPEN-th of all places): where it fits a broadcast, its
        # contexts are told apart in place and never dealt by anchor.
        gathered = lookup_join(different, frequent, "h", "left_anti", stage=True)
        open_ = lookup_join(different, frequent, "h", "left_semi", stage=True)
        # A context that stands twice repeats as a whole.
        whole = F.struct(F.lit(0).alias("s"), (F.length("context") - length).alias("e"))
        runs = (_by_hash(open_, length).join(open_.where("n > 1").select("c1", "c2"),
                                             ["c1", "c2"], "left_anti")
                .union(open_.where("n > 1").select("c1", "c2", F.array(whole))))
    found = (gathered.repartition("h").sortWithinPartitions("h")
             .select("h", "c1", "c2", "n", "at", "context")
             .mapInArrow(_resolve(length), "c1 long, c2 long, s int, e int")
             .groupBy("c1", "c2").agg(F.collect_list(F.struct("s", "e")).alias("runs")))
    # One row per context, so the join gives one row per place.
    runs = cut(found if runs is None else found.union(runs))
    runs = runs.withColumnsRenamed({"c1": "_c1", "c2": "_c2"})
    spans = (seen.select("c1", "c2", "t1", "t2", "lo")
             .join(runs, (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")))
             .groupBy("t1", "t2").agg(F.flatten(F.collect_list(F.transform("runs", lambda r: F.struct(
                 (F.col("lo") + r["s"]).alias("start"),
                 (F.col("lo") + r["e"] + length).alias("end"))))).alias("spans")))
    out = cut(spans)
    delete_path(spark, path)
    return out


def merge_spans(spans) -> list[tuple[int, int]]:
    """Maximal runs covered by (start, end) spans; touching spans are one run."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _remove(batches):
    """Rows (t1, t2, text, spans) to what is removed and what is kept."""
    for b in slices(batches, "text"):
        rows = []
        for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            runs = merge_spans((x["start"], x["end"]) for x in spans)
            edges = [0, *[x for r in runs for x in r], len(t)]
            kept = b"".join(t[s:e] for s, e in zip(edges[::2], edges[1::2]))
            rows.append((len(t) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [b.column("t1"), b.column("t2"), pa.array(cols[0], pa.int64()),
             pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             pa.array(cols[3], pa.binary())],
            names=["t1", "t2", "n_removed", "n_spans", "sha", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   id_col: str = "doc_id", text_col: str = "text",
                   keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, and with ``keep_bytes`` the remaining bytes as ``kept``.

    A null text is empty; texts shorter than ``length`` lose nothing; equal
    texts lose everything, as each repeats the other.  Rows without a doc_id
    count like any other; other columns are not read; an empty table gives
    an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    d = d.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    spans = (repeated_spans(d.select("t1", "t2", "text"), length, gram)
             .withColumnsRenamed({"t1": "_t1", "t2": "_t2"}))
    cut_texts = (_texts(d.select("t1", "t2", "text"), spans.select(F.col("_t1").alias("t1")))
                 .join(spans, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")))
                 .select("t1", "t2", "text", "spans").mapInArrow(
        _remove, "t1 long, t2 long, n_removed long, n_spans long, sha string, kept binary"))
    if not keep_bytes:
        cut_texts = cut_texts.drop("kept")
    copies = (d.where(F.octet_length("text") >= length).groupBy("t1", "t2")
              .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("t1", "t2", F.lit(True).alias("copied")))
    marks = cut(cut_texts.join(copies, ["t1", "t2"], "full")
                .withColumnsRenamed({"t1": "_t1", "t2": "_t2"}))
    rows = d.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"),
                    F.sha2("text", 256).alias("whole"), *(["text"] if keep_bytes else []))
    joined = rows.join(marks, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    copied = F.coalesce("copied", F.lit(False))
    out = ["doc_id", "n_bytes",
           F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
           .alias("n_removed"),
           F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long")
           .alias("n_spans"),
           F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("sha", "whole"))
           .alias("kept_sha256")]
    if keep_bytes:
        out.append(F.when(copied, F.lit("").cast("binary")).otherwise(F.coalesce("kept", "text"))
                   .alias("kept"))
    return joined.select(*out)
