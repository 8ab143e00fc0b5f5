"""Embedding near-duplicates against brute force."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import embeddings
from tests.llm.helpers import union_find

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    """{row number: (n_links, component)} by all pairs, in double precision."""
    ok = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            ok[k] = x / np.linalg.norm(x)
    pairs = [(a, b) for a, b in combinations(ok, 2)
             if len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= cosine]
    n = {k: 0 for k in range(len(rows))}
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    comp = union_find(list(n), pairs)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[comp[k]] = min(i, low.get(comp[k], i))
    return [(i, n[k], low.get(comp[k]) if k in ok else i) for k, (i, _) in enumerate(rows)]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, embeddings.near_duplicates(df, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = [(i, rng.standard_normal(16).tolist()) for i in range(150)]
    for c in range(5):  # clusters of several widths, one larger than the window
        base = rng.standard_normal(16)
        out += [(1000 + 200 * c + k, (base + rng.standard_normal(16) * 0.08 * (c + 1)).tolist())
                for k in range(120 if c == 0 else 12)]
    out += [(3000 + k, out[3][1]) for k in range(4)]
    out += [(4000, [2 * x for x in out[7][1]]), (4001, None), (4002, []), (4003, [0.0] * 16),
            (4004, [1.0, None] * 8), (4005, [float("nan")] * 16), (4006, [float("inf")] + [0.0] * 15),
            (4007, [1.0, 0.0]), (4008, [1.0, 0.0]), (None, out[3][1]), (4009, out[0][1]), (0, out[0][1])]
    return out


def test_against_brute_force(spark, rows):
    assert run(spark, rows, passes=24) == sorted(brute(rows), key=str)


def test_small_windows_and_blocks(spark, rows, monkeypatch):
    """Many blocks and chunks: borders lose nothing that the passes find."""
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    monkeypatch.setattr(embeddings, "CHUNK", 16)
    assert run(spark, rows, passes=24, window=20) == sorted(brute(rows), key=str)


def test_recall_of_borderline_links_on_the_table(spark):
    """Vectors of the table with shifted copies at cosines from 0.9 upwards."""
    rng = np.random.default_rng(2)
    base = [(r.vec_id, np.array(r.embedding, float)) for r in
            spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    for k in range(400):
        v = base[k][1]
        noise = rng.standard_normal(len(v))
        noise -= noise @ v / (v @ v) * v
        base.append((100_000 + k, v + noise / np.linalg.norm(noise) * np.linalg.norm(v)
                     * rng.uniform(0.3, 0.484)))
    x = np.array([v for _, v in base], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in base], SCHEMA)
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df).collect()}
    found = np.array([got[i] for i, _ in base])
    assert len(got) == len(base) and (found <= want).all()  # none below the threshold
    assert want.sum() >= 800 and found.sum() >= 0.98 * want.sum()


def test_passes_follow_size_and_density(spark):
    # Prefixes of a random table of n vectors are dense up to log2(n / window) signs.
    shares = lambda n: {k: float(n / 2 ** k > 64) for k in range(2, 33, 2)}
    counts = [embeddings._passes(shares(n), 0.9) for n in (2_000, 10 ** 5, 10 ** 6, 4 * 10 ** 6)]
    assert counts == sorted(counts) and counts[0] == 16 and counts[2] > 32
    assert embeddings._passes({k: 1.0 for k in range(2, 33, 2)}, 0.9) == 16


def test_recall_in_a_hot_topic(spark):
    """Vectors at a pairwise cosine of about 0.5, with planted pairs at 0.9 to 0.92,
    before windows so small that 16 passes lose many."""
    rng = np.random.default_rng(8)
    n, dim, planted = 6000, 64, 400
    topic = rng.standard_normal(dim) / np.sqrt(dim)
    x = topic + rng.standard_normal((n, dim)) / np.sqrt(dim)
    for k in range(planted):
        v = x[k]
        noise = rng.standard_normal(dim)
        noise -= noise @ v / (v @ v) * v
        x[n - 1 - k] = v + noise / np.linalg.norm(noise) * np.linalg.norm(v) * rng.uniform(0.43, 0.48)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    n_links = lambda **kw: sum(r.n_links > 0 for r in embeddings.near_duplicates(
        df, window=4, **kw).where(F.col("vec_id") < planted).collect())
    assert n_links() >= 0.97 * planted > n_links(passes=16)


def test_corner_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 5)], SCHEMA)
    clash = df.withColumns({c: F.lit("x") for c in ("v", "id", "copies", "pos", "block", "n")})
    assert [tuple(r) for r in embeddings.near_duplicates(clash).collect()] == [(1, 0, 1)]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
