"""Line dedup: edit distance and decisions against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.llm import lines
from tests.llm.helpers import awkward, documents


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (x != y))
    return row[-1]


def edited(rng, s, edits, letters):
    s = list(s)
    for _ in range(edits):
        i = rng.randrange(len(s) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            s.insert(i, rng.choice(letters))
        elif i < len(s):
            s[i:i + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(s)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_within_is_the_edit_distance(spark, k):
    rng, pairs = random.Random(k), []
    for _ in range(300):
        a = "".join(rng.choice("abé\U0001F600") for _ in range(rng.randint(0, 14)))
        pairs.append((a, edited(rng, a, rng.randint(0, 5), "abé\U0001F600")))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", lines.within(F.col("a"), F.col("b"), k).alias("w")).collect()
    for r in got:
        assert r.w == (distance(r.a, r.b) <= k), (r.a, r.b)


def brute(rows, k, min_chars):
    """{(doc_id, text): [(line_no, near)]} of the lines that go."""
    first = {}
    places = []
    for i, t in rows:
        if i is None or t is None:
            continue
        for no, raw in enumerate(t.split("\n")):
            line = raw.strip(" \t\r\f\v")
            if len(line) >= min_chars:
                first[line] = min(first.get(line, (i, no)), (i, no))
                places.append((i, t, no, line))
    order = sorted(first, key=lambda x: (first[x], x.encode()))
    near = {y for n, y in enumerate(order) for x in order[:n]
            if abs(len(x) - len(y)) <= k and distance(x, y) <= k}
    gone = {}
    for i, t, no, line in set(places):
        if line in near or (i, no) > first[line]:
            gone.setdefault((i, t), []).append((no, line in near))
    return gone


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdé "
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 30))) for _ in range(25)]
    rows = []
    for i in range(60):
        text = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3]), letters)
                for _ in range(rng.randint(1, 5))]
        rows.append((i, "\n".join(text)))
    rows += [(200, "template number " + x + " of this long line") for x in ("1", "2", "22", "3")]
    rows += [(300 + n, f"a shared half of a line, then {n:05d} as its own end") for n in range(40)]
    rows += [(5, rows[5][1]), (5, "another text of document five"), (400, None), (401, ""),
             (None, rows[0][1]), (402, "\n\n"), (403, "\r\n".join(["same line in here"] * 3))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,short_list", [(1, 64), (1, 2), (2, 3)])
def test_against_brute_force(spark, k, short_list):
    """Small lists send shared segments through the later rounds."""
    rows = corpus(k)
    got = lines.line_report(documents(spark, rows), k, 8, short_list).collect()
    gone = brute(rows, k, 8)
    want = []
    for i, t in rows:
        g = sorted(gone.get((i, t), []))
        want.append((i, 0 if t is None else t.count("\n") + 1, sum(not n for _, n in g),
                     sum(n for _, n in g), ",".join(str(x) for x, _ in g)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_dedup_rewrites_texts(spark):
    a, b = "the first line of the text", "another line that stands here"
    docs = documents(spark, [(1, f"{a}\nshort\n{b}"), (2, f"{a}s\nshort"), (3, b), (4, None), (5, "")])
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: f"{a}\nshort\n{b}", 2: "short", 4: None, 5: ""}


def test_awkward_and_clashing(spark):
    rows = awkward()
    docs = documents(spark, rows).withColumns(
        {c: F.lit("x") for c in ("doc", "line", "h1", "place", "near", "_gone", "key", "gone")})
    assert lines.line_report(docs).count() == len(rows)
    docs = docs.withColumns({c: F.lit("x") for c in ("_row", "_text", "_id", "_doc", "line_no")})
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns and 0 < out.count() <= len(rows)
    assert {tuple(r)[5:] for r in out.collect()} == {("x",) * (len(docs.columns) - 5)}
    assert lines.line_report(docs.limit(0)).count() == 0
    plan = lines.line_report(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
