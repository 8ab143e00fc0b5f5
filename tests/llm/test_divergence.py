"""Source divergence against a plain version in Python integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import divergence as D
from tests.llm.helpers import documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=10):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        docs[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        v = len(kept)
        sources = {s: counts[lang, s] for x, s in counts if x == lang}
        whole = sum(sources.values(), Counter())

        def prices(c):
            n = sum(c[t] for t in kept)
            return [1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * v) for t in kept]
        of = {s: prices(c) for s, c in sources.items()}
        all_ = prices(whole)
        for s, p in of.items():
            f = lambda a, b: (a - b) ** 2 // (a + b)
            pair = sorted(((sum(map(f, p, q)), t) for t, q in of.items() if t != s),
                          key=lambda x: (-x[0], x[1].encode()))
            term = sorted(((f(a, b), t) for t, a, b in zip(kept, p, all_)
                           if sources[s][t] and a > b), key=lambda x: (-x[0], x[1].encode()))[:top]
            for part, items in (("pair", pair), ("term", term)):
                out += [(lang, s, part, t, value, k + 1) for k, (value, t) in enumerate(items)]
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "déjà", "the", "É", "zwölf", "x1y", "a-b",
             "中文", "it's", "\U0001f642"]
    rows = []
    for i in range(160):
        s = rng.choice(["hot"] * 6 + ["a", "b", None, "", "ä", "Z", "solo\U0001f600"])
        lang = rng.choice(["en", "en", "de", None, ""])
        words = rng.choices(vocab[hash(s or "") % 3:], k=rng.randint(0, 30))
        rows.append((i, rng.choice([" ".join(words), None, ""]) if i % 9 == 0 else " ".join(words),
                     lang, s))
    return rows + [(500, "rare words only", "fr", "one"), (501, "", "fr", "two"), (502, None, "xx", "s"),
                   (None, "alpha", "en", "hot"), (7, "alpha " * 30_000, "en", "empty?"),
                   (8, "!!! 123", "en", "marks")] + [rows[0]] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_a_plain_version(spark, seed):
    rows = rows_of(seed)
    docs = documents(spark, rows).withColumn("value", F.lit("mine")).withColumn("id", F.lit(1))
    got = D.audit(docs.repartition(5))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_blocks_and_tiles_change_nothing(spark):
    rows = rows_of(3)
    terms, counts, groups = D.term_counts(documents(spark, rows), 3)
    whole = sorted(map(tuple, D.pair_values(terms, counts, groups).collect()))
    assert len(whole) > 40
    for block, tile in ((1, 1), (3, 2), (2, 100)):
        parts = D.pair_values(terms, counts, groups, block, tile)
        assert sorted(map(tuple, parts.collect())) == whole


def test_partial_counts_are_handed_on(spark, monkeypatch):
    rows = rows_of(4)
    batches = documents(spark, rows).selectExpr(
        "cast(coalesce(text, '') as binary) text", "coalesce(lang, '') lang",
        "coalesce(source, '') source").repartition(1)
    import pyarrow as pa
    table = pa.Table.from_pandas(batches.toPandas(), preserve_index=False)
    sums = []
    for held in (5, 10**6):
        monkeypatch.setattr(D, "_HELD", held)
        total = Counter()
        for b in D._count(iter(table.to_batches(max_chunksize=7))):
            for r in b.to_pylist():
                total[r["lang"], r["source"], r["term"], "n"] += r["n"]
                total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        sums.append(total)
    assert sums[0] == sums[1]


def test_galloping_finds_shared_ids():
    rng = random.Random(5)
    for _ in range(300):
        span = rng.choice([5, 50, 5000])
        a = sorted(rng.sample(range(span), rng.randint(0, min(span, 200))))
        b = sorted(rng.sample(range(span), rng.randint(0, min(span, 3000))))
        short, long_ = (a, b) if len(a) <= len(b) else (b, a)
        at, other = D.gallop(np.array(short, np.int64), np.array(long_, np.int64), rng.choice([1, 3, 64]))
        assert [short[i] for i in at] == [long_[i] for i in other] == sorted(set(a) & set(b))


def test_prices_are_exact_for_large_counts(spark):
    cases = [(10**14 + k, 3 * 10**15 + k, 10**9 + k) for k in range(5)] + [(0, 0, 1), (9, 9, 1)]
    expected = [1 + 1_000_000_000 * (c + 2) // (n + 2 * v) for c, n, v in cases]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    assert [r.p for r in df.select(D.price(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()] \
        == expected
    assert [int(D._prices(np.array([c]), n, v)[0]) for c, n, v in cases] == expected


def test_empty_tables(spark):
    docs = documents(spark, [(1, None, "en", "a"), (2, "x y", "en", "b")])
    assert sorted(map(tuple, D.audit(docs).collect())) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert D.audit(docs.limit(0)).count() == 0
