"""SimHash: fingerprints and components against a brute-force version."""

import random
import re
from itertools import combinations

import pytest
import xxhash

from starmart.llm import simhash
from tests.llm.helpers import awkward, documents, union_find


def brute_fingerprint(text, size):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_against_brute_force(spark):
    rows = awkward()
    got = simhash.simhash_groups(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [(i, brute_fingerprint(t, 4)) for i, t in rows]
    nodes = {f for _, f in fps}
    comp = union_find(nodes, [(a, b) for a, b in combinations(nodes, 2)
                              if (a ^ b).bit_count() <= 4])
    low = {}
    for i, f in fps:
        if i is not None:
            low[comp[f]] = min(i, low.get(comp[f], i))
    want = sorted(((i, f"{f:016x}", low.get(comp[f])) for i, f in fps), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("max_list", [2, 5, 256])
@pytest.mark.parametrize("max_bits", [3, 4])
def test_components_of_dense_fingerprints(spark, max_list, max_bits):
    """Long posting lists take the finer levels and lose no component."""
    from starmart.llm._components import components
    rng = random.Random(max_list)
    fps = set()
    for _ in range(4):
        base = rng.getrandbits(64)
        bits = rng.sample(range(64), 20)
        for _ in range(60):
            fps.add(base ^ sum(1 << b for b in rng.sample(bits, rng.randint(0, 6))))
    signed = [(simhash._signed(f),) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    got = {r.node: r.component for r in
           components(simhash.links(df, max_bits, max_list)).collect()}
    nodes = [s for s, in signed]
    want = union_find(nodes, [(a, b) for a, b in combinations(nodes, 2)
                              if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits])
    assert {n: got.get(n, n) for n in nodes} == want


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (9, "q r s t u v"), (None, "a b c d e f")]
    docs = documents(spark, rows)
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["3", "9", "None"]


def test_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    docs = documents(spark, [(1, "a b"), (2, "a b")])
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    clash = docs.withColumns({c: F.lit("x") for c in ("fp", "rep", "root", "mask", "component_id")})
    assert {r.component_id for r in simhash.simhash_groups(clash).collect()} == {1}
