"""Periodic runs against a plain search, and the query against its contract."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import runs
from starmart.llm.queries import op11_periodic_runs
from tests.llm.helpers import awkward, documents


def brute(w, exponent=4, least=6):
    """Every maximal stretch of every period, kept if no smaller period holds."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        s = 0
        while s + q < n:
            if w[s] != w[s + q]:
                s += 1
                continue
            t = s
            while t + q < n and w[t] == w[t + q]:
                t += 1
            size = t + q - s
            x = w[s:s + size]
            if size >= max(least, exponent * q) and not any(
                    all(x[i] == x[i + d] for i in range(size - d)) for d in range(1, q)):
                out.append((s, size, q))
            s = t
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    w = [rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 40))]
    if rng.random() < .7:
        unit = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
        w = w[:10] + unit * rng.randint(2, 8) + unit[:rng.randint(0, len(unit))] + w[10:]
    return w


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 6), (4, 1), (2, 9)])
def test_runs_of_random_sequences(exponent, least):
    rng = random.Random(exponent * 10 + least)
    for _ in range(300):
        texts = [random_words(rng) for _ in range(rng.randint(1, 4))]
        ids = np.array([x for t in texts for x in t], np.int64)
        sizes = np.array([len(t) for t in texts])
        expected = [brute(t, exponent, least) for t in texts]
        for piece in (1, 8, 1 << 16):
            assert runs.runs_of(ids, sizes, exponent, least, piece) == expected
        # The automaton alone, on the whole texts.
        assert [sorted(runs.find_runs(t, exponent, least), key=lambda r: (r[0], r[2]))
                for t in texts] == expected


def test_long_runs_cost_no_more_than_their_words():
    for period in (1, 7, 5000):
        assert runs.find_runs([i % period for i in range(60_000)]) == [(0, 60_000, period)]
    # Pieces of a long stretch give one run.
    ids = np.array([9, 8] + [i % 3 for i in range(50_000)] + [7], np.int64)
    assert runs.runs_of(ids, np.array([len(ids)]), piece=64) == [[(2, 50_000, 3)]]


def collapse(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator_on_awkward_rows(spark):
    rows = awkward(5) + [(6000, "a " * 7 + "b c " * 5 + "b"), (6001, "x\x1cy " * 6), (6002, "é " * 6)]
    docs = documents(spark, rows).withColumn("runs", F.lit("mine")).withColumn("collapsed", F.lit(1))
    got = runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    expected = []
    for d, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        # The long text of equal words is one run; the plain search is too slow for it.
        found = [(0, len(words), 1)] if len(words) > 1000 else brute(words)
        expected.append((d, len(words), found, collapse(words, found)))
    rows_of = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    assert sorted(rows_of, key=str) == sorted(expected, key=str)
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, exponent=1)


def planted(doc_id, words):
    """The contract's change of every tenth document."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_follows_its_contract(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("ab" if i % 3 else "abcdefgh")
                         for _ in range(rng.randint(0, 120))) or None)
            for i in range(250)] + [(None, "a a a a a a a"), (300, "")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and any(r.n_runs > 1 for r in got.values())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d, text in rows:
        words = planted(d, (text or "").split()) if d is not None else text.split()
        found = brute(words)
        s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        r = got[d]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), s, n, q)
        assert r.exponent_milli == (1000 * n // q if found else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == sha(collapse(words, found))
