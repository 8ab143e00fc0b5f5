"""The pipeline against plain versions of its stages, and its corner cases."""

import hashlib
import re
import zlib
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from starmart.llm import langid
from tests.llm.helpers import awkward, documents, union_find
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_fingerprint

SF = "/root/testdata/sf0.001"
size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def plain_lines(rows):
    """Lines that stand earlier, up to one edit, leave; rows are (id, text)."""
    first = {}
    split = {i: [(no, raw.strip(" \t\r\f\v")) for no, raw in enumerate(t.split("\n"))]
             for i, t in rows}
    for i, lines in split.items():
        for no, line in lines:
            if len(line) >= 20:
                first[line] = min(first.get(line, (i, no)), (i, no))
    order = sorted(first, key=lambda x: (first[x], x.encode()))
    by_length = {}
    near = set()
    for line in order:
        if any(one_edit(x, line) for n in range(len(line) - 1, len(line) + 2)
               for x in by_length.get(n, ())):
            near.add(line)
        by_length.setdefault(len(line), []).append(line)
    out = []
    for i, t in rows:
        gone = {no for no, x in split[i] if len(x) >= 20 and (x in near or (i, no) > first[x])}
        kept = "\n".join(raw for no, raw in enumerate(t.split("\n")) if no not in gone)
        if not gone or kept.strip(" "):
            out.append((i, kept))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
        out.append((name, docs))
    return out


def test_every_stage_against_its_plain_version(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in stages] == ["language", "line_dedup", "near_duplicates",
                                      "decontamination", "mixing"]
    texts = lambda k: sorted((r.doc_id, r.text) for r in stages[k][1].collect())

    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    assert all(zlib.crc32(str(i).encode()) % 4 != 2
               for i, in docs.where(~langid.held_out(F.col("doc_id"))).select("doc_id").collect())
    want = sorted((i, r.text) for i, r in rows.items()
                  if langid.score_texts([r.text], model)[0][0] != "und"
                  and langid.score_texts([r.text], model)[0][1] >= 0.5)
    assert texts(0) == want and len(want) > 190  # clean documents stay

    want = sorted(plain_lines(want))
    assert texts(1) == want
    assert all(r.n_chars == len(r.text) for r in stages[1][1].collect())

    fps = {i: brute_fingerprint(t, 4) for i, t in want}
    comp = union_find(fps, [(a, b) for a, b in combinations(fps, 2)
                            if (fps[a] ^ fps[b]).bit_count() <= 4])
    want = [(i, t) for i, t in want if comp[i] == i]
    assert texts(2) == want

    words = lambda t: " " + " ".join(re.findall(r"[^\W\d_]+", t or "")) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(i, t) for i, t in want if not any(x in words(t) for x in items)]
    assert texts(3) == want

    by_source = {}
    for i, t in want:
        by_source.setdefault(rows[i].source, []).append((i, size(t)))
    totals = {s: sum(n for _, n in d) for s, d in by_source.items()}
    targets, taken = brute_targets(totals), {}
    for s, queue in by_source.items():
        at = 0
        for i, n in sorted(queue, key=lambda x: hashlib.md5(str(x[0]).encode()).hexdigest()):
            t = int(targets[s])
            taken[i] = sum(max(0, min(n, t - k * totals[s] - at)) for k in range(2))
            at += n
    got = stages[4][1].collect()
    assert {r.doc_id: r.taken for r in got} == {i: n for i, n in taken.items() if n}
    assert [r.position for r in got] == sorted(r.position for r in got)


def test_run_is_the_stages(spark, stages):
    key = lambda df: sorted((r.doc_id, r.taken, r.position) for r in df.collect())
    assert key(P.run(spark, SF)) == key(stages[-1][1])


def test_columns_and_corner_tables(spark):
    docs = documents(spark, [(*r, "en", "s") for r in awkward()]).withColumn(
        "h1", F.lit("mine")).withColumn("component_id", F.lit(1)).withColumns(
        {c: F.lit("x") for c in ("_gone", "_row", "row", "size", "target", "_taken", "_position",
                                 "lang_pred", "score", "fingerprint")})
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out = stage(spark, docs, SF)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        out.collect()
    clash = docs.withColumn("Taken", F.lit("x")).withColumn("position", F.lit("x"))
    out = P.mix(spark, clash, SF)
    assert out.columns == [*docs.columns, "taken", "position"]
    assert all(isinstance(r.position, float) for r in out.collect())
