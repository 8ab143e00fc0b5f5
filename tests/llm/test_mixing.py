"""Mixing: targets, words taken and positions against a plain version."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm import mixing
from starmart.llm.queries import op8_mix_sources
from tests.llm.helpers import awkward, documents


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        level = rest / sum(w[s] for s in free) if free else 0
        over = {s for s in free if w[s] * level > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else w[s] * level for s in order}
        capped |= over


def rows_of(seed):
    sources = ["b", None, "a", "ä", "hot", "hot", "hot", "", "Z"]
    return [(i, t, "en", sources[k % len(sources)]) for k, (i, t) in enumerate(awkward(seed))]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_words_taken(spark, seed):
    rows = rows_of(seed)
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size(t)
    targets = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert all(0 <= p <= 1 for p in r.positions)
        assert len(r.positions) == (r.taken > 0) + (r.taken > r.size)
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1 + 1e-6 * t
    key = lambda r: str((r.doc_id, r.source, r.size, r.taken, r.positions))
    again = mixing.mix(documents(spark, rows).repartition(5)).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_positions_follow_the_schedule(spark):
    """A source with a falling weight gives more of its words early."""
    docs = documents(spark, [(i, "w " * 10, "en", s) for i in range(400) for s in "abc"])
    got = mixing.mix(docs).select("source", F.explode("positions").alias("p"))
    early = {r.source: r.e for r in got.groupBy("source")
             .agg(F.avg((F.col("p") < 0.5).cast("int")).alias("e")).collect()}
    # Slopes -0.5, 0, 0.5: shares of the first half are 0.625, 0.5, 0.375.
    assert early["a"] == pytest.approx(0.625, abs=0.02)
    assert early["b"] == pytest.approx(0.5, abs=0.02)
    assert early["c"] == pytest.approx(0.375, abs=0.02)


def test_stream_is_ordered_and_keeps_columns(spark):
    docs = documents(spark, rows_of(4)).withColumn("target", F.lit("mine"))
    out = mixing.training_stream(docs)
    assert out.columns == [*docs.columns, "_taken", "_position"]
    got = out.collect()
    assert [r._position for r in got] == sorted(r._position for r in got)
    assert {r.target for r in got} == {"mine"}


def test_empty_tables(spark):
    docs = documents(spark, [(1, None), (2, "", "en", "a")])
    assert {r.taken for r in mixing.mix(docs).collect()} == {0}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.training_stream(docs).count() == 0


def test_query_columns(spark):
    q = op8_mix_sources(spark, "/root/testdata/sf0.001")
    assert q.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
