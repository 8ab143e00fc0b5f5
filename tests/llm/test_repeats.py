"""Removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import repeats
from tests.llm.helpers import awkward, documents


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[s:s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé\0") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(4, 40)) for _ in range(6)]
    rows = []
    for i in range(50):
        parts = [text(rng.randint(0, 12)) + rng.choice(shared)[rng.randint(0, 9):]
                 for _ in range(rng.randint(0, 3))]
        rows.append((i, text(3).join(parts)))
    base = rows[7][1] + text(40)
    for i in range(12):  # near copies
        t = list(base)
        t[rng.randrange(len(t))] = "#"
        rows.append((100 + i, "".join(t)))
    rows += [(200, "a" * 150), (201, "a" * 31 + "b"), (202, "xyz" * 60), (203, "q" * 30),
             (204, None), (205, ""), (206, None), (None, rows[3][1]), (3, rows[3][1])]
    rng.shuffle(rows)
    return rows


def check(spark, rows, length, gram):
    got = repeats.remove_repeats(documents(spark, rows), length, gram, keep_bytes=True).collect()
    want = sorted(brute(rows, length), key=str)
    have = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
                   for r in got], key=str)
    assert have == want
    assert any(r.n_removed for r in got) and any(not r.n_removed for r in got)


@pytest.mark.parametrize("seed,length,gram", [(1, 30, 8), (2, 20, 20)])
def test_against_brute_force(spark, seed, length, gram):
    check(spark, corpus(seed), length, gram)


@pytest.mark.parametrize("most", [3, 12])
def test_frequent_anchors_go_by_hashes(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "_OPEN", most)
    check(spark, corpus(3), 30, 8)


def test_runs_of_hashes_are_folded(spark):
    """One row per context, with the same runs as the gathered contexts give."""
    import pyarrow as pa
    rng = random.Random(9)
    base = [rng.choice(b"abcdef") for _ in range(18)]
    contexts = set()
    for _ in range(60):
        c = list(base)
        for _ in range(rng.randint(1, 2)):
            c[rng.randrange(18)] = rng.choice(b"xyz")
        contexts.add(bytes(c[:rng.randint(12, 18)]))
    rows = [(7, k, 0, 1, 6, c) for k, c in enumerate(sorted(contexts))]
    names = ["h", "c1", "c2", "n", "at", "context"]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(6)],
                                       names=names)
    gathered = {}
    for b in repeats._resolve(12)([batch]):
        for x in b.to_pylist():
            gathered.setdefault(x["c1"], []).append((x["s"], x["e"]))
    got = repeats._by_hash(spark.createDataFrame(
        [(*r[:5], bytearray(r[5])) for r in rows],
        "h long, c1 long, c2 long, n long, at int, context binary"), 12).collect()
    assert len({r.c1 for r in got}) == len(got) == len(gathered) > 5
    assert {r.c1: [tuple(x) for x in r.runs] for r in got} == {
        k: sorted(v) for k, v in gathered.items()}


def test_groups_merged_in_parts():
    """Groups are never cut; flushing between them changes nothing."""
    import pyarrow as pa
    rng = random.Random(6)
    rows = [(g, g * 100 + k, 0, 1 + (k == 0 and g % 5 == 0), 4,
             bytes(rng.choice(b"ab") for _ in range(rng.randint(12, 16))))
            for g in range(40) for k in range(rng.randint(1, 6))]
    batches = lambda n: [pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows[s:s + n]]) for i in range(6)], names=list("abcdef"))
        for s in range(0, len(rows), n)]
    whole = [x for b in repeats._resolve(12)(batches(1000)) for x in b.to_pylist()]
    before = repeats._MERGE
    try:
        repeats._MERGE = 5
        parts = [x for b in repeats._resolve(12)(batches(7)) for x in b.to_pylist()]
    finally:
        repeats._MERGE = before
    assert sorted(map(str, whole)) == sorted(map(str, parts)) and whole


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(n)).encode() for n in (90, 400, 10, 33)]
    whole = set(zip(*[c.tolist() for c in repeats.anchors(texts, 30, 8)]))
    monkeypatch.setattr(repeats, "_PIECE", 64)
    starts = {}
    for i, h, a, lo, hi in zip(*[c.tolist() for c in repeats.anchors(texts, 30, 8)]):
        for s in range(lo, hi + 1):
            assert (i, s) not in starts and s <= a <= s + 22
            starts[i, s] = (h, a)
    assert starts == {(i, s): (h, a) for i, h, a, lo, hi in whole for s in range(lo, hi + 1)}
    assert {i for i, _ in starts} == {0, 1, 3}


@pytest.mark.parametrize("n,shard", [(1, 4), (7, 4), (200, 16), (300, 4096)])
def test_merged_order(n, shard):
    rng = np.random.default_rng(n)
    rows = rng.integers(0, 3, (n, 21)).astype(np.uint8)
    rows[:, 2:] *= rng.integers(0, 2, (n, 1)).astype(np.uint8)  # long common prefixes
    order, prefix = repeats.merged_order(rows, shard)
    listed = [bytes(rows[i]) for i in order]
    assert listed == sorted(map(bytes, rows))
    for a, b, p in zip(listed, listed[1:], prefix[1:]):
        same = next((k for k in range(21) if a[k] != b[k]), 24)
        assert p == same


def test_corner_tables(spark):
    rows = awkward()
    docs = documents(spark, rows).withColumns(
        {c: F.lit("x") for c in ("t1", "h", "spans", "n_bytes", "anchors", "kept", "copied")})
    out = repeats.remove_repeats(docs)
    assert out.count() == len(rows)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
