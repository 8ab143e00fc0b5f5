"""Fixtures of the operator tests: small tables with the awkward rows."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((*r, len(r[1]) if r[1] is not None else None))
    return spark.createDataFrame(full, DOCS)


def awkward(seed: int = 3, n: int = 60):
    """Texts with nulls, empties, repeats, ties, near copies and a long one."""
    rng = random.Random(seed)
    vocab = ["alpha", "Béta", "gamma", "delta", "the", "of", "zwölf", "x1", "end."]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 60))) for _ in range(n // 3)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(n // 3):
        words = rng.choice(base).split(" ")
        words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000 + i, base[0]) for i in range(5)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t "), (3003, None), (None, base[1]),
             (None, None), (4000, base[2]), (4000, base[2]), (5000, "word " * 30000), (-7, "one")]
    rng.shuffle(rows)
    return rows


def union_find(nodes, pairs):
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
