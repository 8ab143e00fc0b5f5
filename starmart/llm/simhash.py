"""SimHash near-duplicates (operator 4).

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles.  Two fingerprints link when they differ in at most
``max_bits`` of 64 bits.

Search: an inverted index over the eight byte positions.  Four differing bits
touch at most four bytes, so linked fingerprints share at least
``8 - max_bits`` positional bytes: that is the guaranteed minimum count.
Posting lists of single bytes hold 1/256 of all rows, so instead of tallying
every pair of every list, the lists are intersected: a pair reaches the
minimum count exactly when it meets under some choice of that many positions,
so each fingerprint is posted once per choice under (positions, their bytes).
Every pair that meets is verified by its differing bits.  The number of
choices is a constant (70 for four bits).

Hot posting lists: in a list longer than ``max_list`` every member is verified
only against the list's smallest fingerprint and its neighbours in order.
After the links found so far are merged, a long list whose members already
belong to one component needs no more work.  The others are posted again
under a finer choice (the bytes not yet fixed are split into nibbles, then
bit pairs, and the same counting argument holds for them); at the last level
56 of 64 bits are fixed and a list cannot hold more than 256 fingerprints,
all verified.  So no pair is lost and no list is expanded into all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._components import components
from starmart.llm._util import LOWER, cut, map_texts

MAX_LIST = 256
_SEED = 42


def _shingles(text: bytes, size: int) -> list[bytes]:
    words = text.translate(LOWER).split()  # bytes.split: exactly the six ASCII spaces
    if not words:
        return []
    joined, ends, at = b" ".join(words), [], 0
    for w in words:
        at += len(w)
        ends.append(at)
        at += 1
    if len(words) <= size:
        return [joined]
    starts = [0] + [e + 1 for e in ends[:-1]]
    return [joined[s:e] for s, e in zip(starts, ends[size - 1:])]


def fingerprint(text: bytes | None, size: int) -> int:
    """Unsigned 64-bit SimHash of one text; 0 without words."""
    grams = _shingles(text or b"", size)
    if not grams:
        return 0
    digest, seed, n = xxhash.xxh64_intdigest, _SEED, len(grams)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounds the bit matrix of very long texts
        part = grams[at:at + 65536]
        h = np.fromiter((digest(g, seed) for g in part), np.uint64, len(part))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed bigint."""
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                    F.col(f"`{text_col}`").cast("string").cast("binary").alias("_text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in b.column("_text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))],
                                          names=["doc_id", "fp"])
    return map_texts(d, run, "doc_id long, fp long", "_text")


def _finer(mask: int, level: int, keep: int) -> list[int]:
    """Masks that fix ``keep`` more of the eight units left free by ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    width = len(free) // 8
    units = [sum(1 << b for b in free[i * width:(i + 1) * width]) for i in range(8)]
    return [mask | sum(units[i] for i in c) for c in combinations(range(8), keep)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _scan(max_bits: int, max_list: int):
    """mapInArrow over rows sorted by (mask, key, fp): links and long lists.

    Reads each posting list as one run of rows.  Up to ``max_list`` rows are
    held; lists that end within that are verified pair by pair, longer ones
    stream through with links to their first row and to the row before, and
    their members are passed on (``b`` null).
    """
    def verified(mask, fps):
        n = len(fps)
        x = fps.view(np.uint64)
        near = np.bitwise_count(x[:, None] ^ x[None, :]) <= max_bits
        seen, out = np.zeros(n, bool), []
        for i in range(n):  # a spanning forest of the list's links
            if seen[i]:
                continue
            seen[i], stack = True, [i]
            while stack:
                j = stack.pop()
                new = np.nonzero(near[j] & ~seen)[0]
                seen[new] = True
                stack.extend(new.tolist())
                out.extend((mask, int(fps[k]), int(fps[j])) for k in new)
        return out

    def run(batches):
        rest = None
        hot = None  # (mask, key, first, previous) of a long list still open
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            m, k, f = cols
            if not len(m):
                continue
            cuts = np.nonzero((m[1:] != m[:-1]) | (k[1:] != k[:-1]))[0] + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(m)]])
            out: list[tuple] = []
            last = len(starts) - 1
            rest = None
            lone = ends - starts
            # Lists of two, by far the most, all at once.
            two = np.nonzero((lone == 2) & (np.arange(len(starts)) < last))[0]
            if hot is not None:
                two = two[two > 0]
            s = starts[two]
            s = s[np.bitwise_count(f[s].view(np.uint64) ^ f[s + 1].view(np.uint64)) <= max_bits]
            out.extend(zip(m[s].tolist(), f[s + 1].tolist(), f[s].tolist()))
            for g in np.nonzero((lone > 2) | (np.arange(len(starts)) == last)
                                | ((np.arange(len(starts)) == 0) & (hot is not None)))[0]:
                a, e = starts[g], ends[g]
                if hot is not None and (m[a], k[a]) != hot[:2]:
                    hot = None
                if hot is None and e - a <= max_list:
                    if g == last:  # may go on in the next batch
                        rest = [m[a:e], k[a:e], f[a:e]]
                    elif e - a > 1:
                        out.extend(verified(int(m[a]), f[a:e]))
                    continue
                x = f[a:e]
                first = hot[2] if hot else x[0]
                prev = np.concatenate([[hot[3] if hot else x[0]], x[:-1]])
                for other in (np.full(len(x), first), prev):
                    near = (np.bitwise_count(x.view(np.uint64) ^ other.view(np.uint64))
                            <= max_bits) & (x != other)
                    out.extend(zip([int(m[a])] * int(near.sum()), x[near].tolist(),
                                   other[near].tolist()))
                out.extend((int(m[a]), int(v), None) for v in x)
                hot = (m[a], k[a], first, x[-1])
            if out:
                yield _rows(out)
        if rest is not None and len(rest[0]) > 1:
            out = verified(int(rest[0][0]), rest[2])
            if out:
                yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["mask", "a", "b"])
    return run


def links(fps: DataFrame, max_bits: int = 4, max_list: int = MAX_LIST) -> DataFrame:
    """Edges (a, b) among distinct fingerprints (column ``fp``, distinct rows)
    whose components are those of all pairs within ``max_bits`` bits."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7: the guaranteed minimum is 8 - max_bits")
    keep, spark = 8 - max_bits, fps.sparkSession
    first = [_signed(x) for x in _finer(0, 1, keep)]
    posted = fps.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in first]))
                        .alias("mask"))
    edges, level = None, 1
    while True:
        keyed = posted.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        # The last level fixes all but a few bits: its lists are short by
        # construction and are verified whole.
        whole = 64 - _fixed(level, keep) <= 8
        lists = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        found = cut(lists.mapInArrow(_scan(max_bits, 1 << 16 if whole else max_list),
                                     "mask long, a long, b long"))
        new = found.where("b is not null").select("a", "b").distinct()
        edges = new if edges is None else edges.union(new)
        long = found.where("b is null")
        if whole or long.isEmpty():
            return edges
        # Long lists that span several components are posted again, finer.
        comp = components(edges)
        members = (long.select("mask", F.col("a").alias("fp"))
                   .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
                   .join(comp, F.col("fp") == comp["node"], "left")
                   .select("mask", "key", "fp",
                           F.coalesce("component", "fp").alias("component")))
        open_ = (members.groupBy("mask", "key")
                 .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .where("lo < hi").select("mask", "key"))
        members = members.join(open_, ["mask", "key"], "left_semi").select("mask", "fp")
        masks = cut(members.select("mask").distinct())
        level += 1

        def expand(batches, level=level):
            for b in batches:
                for m in b.column(0).to_pylist():
                    finer = [_signed(x) for x in _finer(m & (1 << 64) - 1, level, keep)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([m] * len(finer), pa.int64()), pa.array(finer, pa.int64())],
                        names=["mask", "finer"])
        finer = masks.mapInArrow(expand, "mask long, finer long")
        posted = members.join(finer, "mask").select("fp", F.col("finer").alias("mask")).distinct()


def _fixed(level: int, keep: int) -> int:
    free = 64
    for _ in range(level):
        free -= keep * (free // 8)
    return 64 - free


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                   text_col: str = "text", max_list: int = MAX_LIST) -> DataFrame:
    """One row per document: doc_id, fp (signed bigint), fingerprint (16 hex
    digits), component_id (smallest doc_id reachable over links, itself included).

    A null or empty text has fingerprint zero and links like any other.  Rows
    with a null doc_id get a fingerprint and the component of their links
    (null if no row with a doc_id is among them).  Repeated doc_ids give a row
    each.  Other columns of ``docs`` are not read.  An empty table gives none.
    """
    fp = cut(fingerprints(docs, shingle, id_col, text_col))
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    comp = components(links(distinct.select("fp"), max_bits, max_list))
    # Components are over fingerprints; the smallest doc_id of each follows.
    of = distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("root"))
    low = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = of.join(low, "root").select(F.col("fp").alias("_fp"), "component_id")
    return fp.join(named, fp["fp"] == named["_fp"], "left").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` without the documents whose component holds a smaller doc_id.

    One document of each group stays: of rows that repeat the kept doc_id all
    stay, as do rows without a doc_id, which cannot be told apart.
    """
    gone = (simhash_groups(docs, shingle, max_bits)
            .where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
