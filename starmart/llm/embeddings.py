"""Embedding near-duplicates by sorted projection passes (operator 2).

Each pass hashes a vector to the signs of 64 random projections and orders all
vectors lexicographically by the concatenated signs, so near vectors share a
long prefix and sit close.  Every vector is compared with the ``window`` before
it; verified pairs (cosine in double precision) of all passes are united into
components.

The number of passes follows from the table: a window covers less of a larger or
denser one, so pilot passes count how many signs it takes until at most a window
of vectors share them, and there are passes enough to meet a pair at the
threshold with an expected recall of RECALL, whatever the size.

Window borders: the order is cut into blocks of ``block`` places, and the last
``window`` rows of a block are repeated in the next, so the windows do not
depend on the partitioning.  Only (pass, signs, id) is range-sorted; vectors
move once to meet their places and once to their blocks.

Bounded windows see only part of a dense neighbourhood, which is enough to
unite it.  Its links are then counted exactly: each component's vectors are
dealt into chunks, and pairs of chunks are multiplied as matrices, which yields
one count per vector and chunk and never a list of pairs.  Equal vectors are
one vector with a count of copies throughout.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (binds pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._components import components
from starmart.llm._util import cut
from starmart.operators.keys import assign_key

#: Passes at least; more follow from the table, see ``_passes``.
PASSES = 16
WINDOW = 64
#: Expected share of the pairs at the threshold that a window meets.
RECALL = 0.99
#: Pilot passes, and lengths of sign prefixes, that show how dense the table is.
_PILOT = 2
_PREFIXES = range(2, 33, 2)
BLOCK = 2048
CHUNK = 1024
_SEED = 20


@lru_cache(maxsize=1024)
def _directions(n_pass: int, dim: int) -> np.ndarray:
    return np.random.default_rng([_SEED, n_pass, dim]).standard_normal((dim, 64))


def _unit(rows: pa.Array, at: np.ndarray | None = None) -> np.ndarray:
    """Lists of one length as unit vectors in double precision."""
    if at is not None and len(at) < len(rows):
        rows = rows.take(pa.array(at))
    x = rows.flatten().to_numpy().reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _sign_rows(passes: int):
    """(id, v) to (pass, dim, sig, id): one row per pass."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            dims = pa.compute.list_value_length(b.column(1)).to_numpy()
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                x = _unit(b.column(1), at)
                for p in range(passes):
                    bits = np.packbits(x @ _directions(p, int(dim)) > 0, axis=1)
                    # First projection most significant; flip for signed order.
                    sig = bits.view(">u8").astype(np.uint64).ravel() ^ np.uint64(1 << 63)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), p, np.int32)),
                         pa.array(np.full(len(at), dim, np.int32)),
                         pa.array(sig.view(np.int64)), pa.array(ids[at])],
                        names=["pass", "dim", "sig", "id"])
    return run


def _groups(batches, keys: int):
    """Runs of equal leading ``keys`` columns of sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy() for i in range(keys)], axis=1)
        cuts = np.concatenate([[0], np.nonzero((k[1:] != k[:-1]).any(axis=1))[0] + 1, [len(k)]])
        for s, e in zip(cuts[:-1], cuts[1:]):
            key = tuple(k[s].tolist())
            if held and key != last:
                yield last, pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(b.slice(s, e - s))
            last = key
    if held:
        yield last, pa.Table.from_batches(held).combine_chunks()


def _window_links(window: int, cosine: float):
    """Rows (block, pos, pass, dim, id, v) by (block, pos) to links (a, b).

    Within a block the verified pairs are united at once, and each vector is
    linked to the first of its union.
    """
    def run(batches):
        for _, t in _groups(batches, 1):
            part = np.stack([t.column(c).to_numpy() for c in ("pass", "dim")], axis=1)
            pos, ids = t.column("pos").to_numpy(), t.column("id").to_numpy()
            vectors = t.column("v").combine_chunks()
            edges = np.nonzero((part[1:] != part[:-1]).any(axis=1))[0] + 1
            for s, e in zip([0, *edges], [*edges, len(pos)]):
                n = e - s
                if n < 2:
                    continue
                x = _unit(vectors.slice(s, n))
                pairs = []
                for k in range(1, min(window, n - 1) + 1):
                    near = np.einsum("ij,ij->i", x[k:], x[:-k]) >= cosine
                    near &= pos[s + k:e] - pos[s:e - k] <= window
                    j = np.nonzero(near)[0]
                    pairs.append(np.stack([j, j + k], axis=1))
                pairs = np.concatenate(pairs)
                root = np.arange(n)
                while len(pairs):  # smallest reachable row, by repeated minima
                    low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
                    new = root.copy()
                    np.minimum.at(new, pairs[:, 0], low)
                    np.minimum.at(new, pairs[:, 1], low)
                    new = new[new]
                    if (new == root).all():
                        break
                    root = new
                linked = np.nonzero(root != np.arange(n))[0]
                if len(linked):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[s + linked]), pa.array(ids[s + root[linked]])],
                        names=["a", "b"])
    return run


def _chunk_counts(cosine: float):
    """Rows (component, dim, lo, hi, id, side, copies, v) by chunk pair to (id, n)."""
    def run(batches):
        for (_, _, lo, hi), t in _groups(batches, 4):
            side = t.column("side").to_numpy()
            ids, copies = t.column("id").to_numpy(), t.column("copies").to_numpy()
            x = _unit(t.column("v").combine_chunks())
            a, b = np.nonzero(side == lo)[0], np.nonzero(side == hi)[0]
            for s in range(0, len(a), CHUNK):  # bounds the matrix of a large chunk
                rows = a[s:s + CHUNK]
                near = x[rows] @ x[b].T >= cosine
                if lo == hi:
                    near[np.arange(len(rows)), np.arange(s, s + len(rows))] = False
                out = [(rows, near @ copies[b])]
                if lo != hi:
                    out.append((b, copies[rows] @ near))
                for at, n in out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(n.astype(np.int64))], names=["id", "n"])
    return run


def _prefix_shares(distinct: DataFrame, window: int) -> dict[int, float]:
    """Share of the vectors, over pilot passes, whose first signs of each length
    are those of more than ``window`` vectors."""
    signs = distinct.select("id", "v").mapInArrow(
        _sign_rows(_PILOT), "pass int, dim int, sig long, id long")
    longest = max(_PREFIXES)
    counted = (signs.groupBy("pass", "dim", F.shiftright("sig", 64 - longest).alias("head"))
               .agg(F.count(F.lit(1)).alias("n")))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("bits"), F.shiftright("head", longest - k)
                                        .alias("head")) for k in (0, *_PREFIXES)])).alias("x")
    dense = (counted.select("pass", "dim", "n", each)
             .groupBy("pass", "dim", "x.bits", "x.head").agg(F.sum("n").alias("n"))
             .where((F.col("n") > window) | (F.col("bits") == 0))
             .groupBy("bits").agg(F.sum("n").alias("n")))
    found = {r.bits: r.n for r in dense.collect()}  # one row per length
    total = found.get(0, 0)
    return {k: found.get(k, 0) / total if total else 0.0 for k in _PREFIXES}


def _passes(shares: dict[int, float], cosine: float, recall: float = RECALL) -> int:
    """Passes after which a pair at ``cosine`` is expected to have met.

    A pass meets the pair if its first signs agree up to a length that at most
    ``window`` vectors share; one sign agrees with probability 1 - angle / pi.
    The expectation is over the vectors.  Those that share even the longest
    prefix with more than a window of others are copies of each other, which a
    component unites through any of its many links; they are left out.
    """
    agree = 1 - np.arccos(min(1.0, max(-1.0, cosine))) / np.pi
    lengths = np.array(sorted(shares))
    alive = np.array([1.0, *[shares[k] for k in lengths]])
    mass = alive[:-1] - alive[1:]  # vectors whose prefix of that length is rare first
    if mass.sum() <= 0:
        return PASSES
    miss = 1 - agree ** lengths
    missed = lambda n: (mass * miss ** n).sum() / mass.sum()
    n = PASSES
    while missed(n) > 1 - recall:
        n += 1
    return n


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, passes: int | None = None,
                    window: int = WINDOW, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, nor do rows without an id or vectors of another length.
    Repeated rows are copies that link with each other; rows that repeat an id
    with other vectors are one node of the link graph.  Other columns are not
    read; an empty table gives an empty result.  Without ``passes`` their number
    follows from the table, so that the expected recall stays RECALL.
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad
            & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    hashed = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")]
    distinct = cut(rows.where("good").groupBy("v")
                   .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
                   .select("id", "copies", "v", *hashed))

    if passes is None:
        passes = _passes(_prefix_shares(distinct, window), cosine)
    signs = distinct.select("id", "v").mapInArrow(
        _sign_rows(passes), "pass int, dim int, sig long, id long")
    places = assign_key(signs, ["pass", "dim", "sig", "id"], "pos")
    block = F.floor(F.col("pos") / BLOCK)
    places = places.select("pass", "dim", "pos", F.col("id").alias("_id"), F.explode(
        F.when(F.col("pos") % BLOCK >= BLOCK - window, F.array(block, block + 1))
        .otherwise(F.array(block))).alias("block"))
    near = (places.join(distinct, F.col("_id") == F.col("id"))
            .select("block", "pos", "pass", "dim", "id", "v")
            .repartition("block").sortWithinPartitions("block", "pos", "id"))
    comp = cut(components(near.mapInArrow(_window_links(window, cosine), "a long, b long")))

    # Exact numbers of links, by pairs of chunks of a component.
    sizes = (comp.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
             .select(F.col("component").alias("_c"),
                     F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")))
    members = (distinct.join(comp, F.col("id") == F.col("node"))
               .join(sizes, F.col("component") == F.col("_c"))
               .withColumn("side", F.pmod(F.xxhash64("k1", "id"), F.col("chunks")).cast("int")))
    dealt = (members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("component", F.size("v").alias("dim"), F.least("side", "other").alias("lo"),
                     F.greatest("side", "other").alias("hi"), "id", "side", "copies", "v")
             .repartition("component", "dim", "lo", "hi")
             .sortWithinPartitions("component", "dim", "lo", "hi"))
    counts = dealt.mapInArrow(_chunk_counts(cosine), "id long, n long")
    # An id that repeats with other vectors has the links of any of them.
    counts = counts.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "_cid")

    result = (distinct.join(comp, F.col("id") == F.col("node"), "left")
              .join(counts, F.col("id") == F.col("_cid"), "left")
              .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                      F.coalesce("component", "id").alias("c"))
              .withColumnsRenamed({"k1": "_k1", "k2": "_k2"}))
    keyed = rows.select("id", "good", *[F.when(F.col("good"), k).alias(n)
                                        for k, n in zip(hashed, ("k1", "k2"))])
    return keyed.join(result, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")),
                      "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "id").alias("component_id"))
