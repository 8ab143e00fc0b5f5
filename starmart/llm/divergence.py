"""Audit of how sources of one language differ in their words (operator 13).

Terms are runs of letters (ASCII letters, and anything beyond ASCII), A-Z in
lower case.  A language keeps the V terms that at least ``min_docs`` of its
documents hold.  Every source of a language, and the language itself, gives each
kept term a price from its count c there:

    p = 1 + floor(SCALE (c + 2) / (N + 2 V)),    N = its count of all kept terms

and two prices differ by floor((p - q)^2 / (p + q)).  The audit reports, for each
source, the sum over all kept terms against each other source of the language
(part ``pair``), and the terms it holds most above the language (part ``term``).
All arithmetic is exact, in integers.

Pair tasks: the counts of a source are an array of (term id, count) sorted by
id, cut into blocks of term ids.  Sources of a language are dealt into tiles of a
few; the arrays of two tiles and one block meet in a cogroup task.  There every
unordered pair of sources is merged: a galloping intersection finds the shared
terms; shared, one-sided and absent terms are each priced.  A pair is summed
over its blocks, and holds in both directions, as the difference is symmetric.
An array moves once per tile of its language, and a task holds two tiles' arrays
of one block, whatever the number of terms.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm._util import cut, slices
from starmart.operators.keys import assign_key

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Term ids of a block, and sources of a tile.
BLOCK = 1 << 16
TILE = 8
#: Partial counts that a task holds before it hands them on.
_HELD = 400_000

#: Bytes that are no part of a term to spaces, A-Z to lower case.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def _count(batches):
    """Partial (lang, source, term, n, docs): occurrences and documents.  A group
    without terms gives one row with a null term."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def flush():
        rows = [(lang, source, term, n, docs[term]) for (lang, source), (count, docs) in held.items()
                for term, n in count.items()]
        rows += [(*group, None, 0, 0) for group in held]
        held.clear()
        for s in range(0, len(rows), 100_000):
            columns = list(zip(*rows[s:s + 100_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.binary(),
                                                                pa.int64(), pa.int64()))],
                names=["lang", "source", "term", "n", "docs"])
    for b in slices(batches, "text"):
        texts: dict[tuple, list[list[bytes]]] = {}
        for lang, source, text in zip(*[b.column(c).to_pylist()
                                        for c in ("lang", "source", "text")]):
            # Terms end at the space that separates them, never inside a character.
            texts.setdefault((lang, source), []).append(text.translate(_TERMS).split(b" "))
        for group, words in texts.items():
            count, docs = held.setdefault(group, (Counter(), Counter()))
            count.update(chain.from_iterable(words))
            docs.update(chain.from_iterable(map(set, words)))
            del count[b""], docs[b""]
        if sum(len(c) for c, _ in held.values()) > _HELD:
            yield from flush()
    yield from flush()


def price(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 2) / (total + 2 kept)) in 64-bit integers: three
    decimal digits of SCALE at a time, so nothing overflows for totals below 9e15."""
    below = total + 2 * kept
    whole, rest = F.lit(0).cast("long"), count + 2
    digits = SCALE
    while digits > 1:
        step = min(1000, digits)
        rest = rest * step
        whole = whole * step + _div(rest, below)
        rest = rest % below
        digits //= step
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _prices(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    below = total + 2 * kept
    whole, rest = np.zeros(len(count), np.int64), count.astype(np.int64) + 2
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // below
        rest %= below
    return whole + 1


def _differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray, step: int = 64):
    """Places in both sorted arrays of the ids they share.  Runs of ``step`` ids of
    the shorter one are looked for from where the last run ended in the longer
    one: the reach doubles until it passes the run, then the run is searched
    inside that reach."""
    mine, other, low = [], [], 0
    for s in range(0, len(short), step):
        run = short[s:s + step]
        reach = step
        while low + reach < len(long) and long[low + reach] < run[-1]:
            reach *= 2
        inside = long[low:low + reach + 1]
        at = np.searchsorted(inside, run)
        hit = np.nonzero(at < len(inside))[0]
        hit = hit[inside[at[hit]] == run[hit]]
        mine.append(s + hit)
        other.append(low + at[hit])
        low += int(at[-1])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(mine), np.concatenate(other)) if mine else (empty, empty)


def pair_value(a, b, kept: int, block: int) -> int:
    """Sum of the differences of two sources over the ``block`` terms of a block.
    Each source is (ids, counts, total of its counts in all blocks)."""
    swap = len(a[0]) > len(b[0])
    (ids, count, total), (ids_b, count_b, total_b) = (b, a) if swap else (a, b)
    at, at_b = gallop(ids, ids_b)
    none, none_b = (int(_prices(np.zeros(1, np.int64), t, kept)[0]) for t in (total, total_b))
    p, q = _prices(count, total, kept), _prices(count_b, total_b, kept)
    alone, alone_b = np.ones(len(ids), bool), np.ones(len(ids_b), bool)
    alone[at], alone_b[at_b] = False, False
    absent = block - len(ids) - len(ids_b) + len(at)
    return int(_differences(p[at], q[at_b]).sum() + _differences(p[alone], none_b).sum()
               + _differences(q[alone_b], none).sum()
               + absent * ((none - none_b) ** 2 // (none + none_b)))


def _pair_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Two tiles of a language over one block: a value for each unordered pair."""
    lang, _, tile_a, tile_b = (x.as_py() for x in key)

    def sources(t: pa.Table):
        out = []
        for r in range(t.num_rows):
            x = {c: t.column(c)[r] for c in t.column_names}
            ids, counts = (np.asarray(x[c].values if x[c].is_valid else [], np.int64)
                           for c in ("ids", "counts"))
            out.append((x["source"].as_py(), (ids, counts, x["total"].as_py()), x["kept"].as_py(),
                        x["size"].as_py()))
        return sorted(out, key=lambda s: s[0])
    a, b = sources(left), sources(right)
    rows = [(s, t, pair_value(x, y, kept, size)) for i, (s, x, kept, size) in enumerate(a)
            for t, y, _, _ in (a[i + 1:] if tile_a == tile_b else b)]
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()),
                     "a": pa.array(columns[0], pa.string()), "b": pa.array(columns[1], pa.string()),
                     "value": pa.array(columns[2], pa.int64())})


def term_counts(docs: DataFrame,
                min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept terms, their counts, and sizes of all groups.

    terms: lang, term, lang_n (occurrences in the language), id (from 0 by lang
    and term).  counts: lang, source, term, id, n, lang_n.  groups: lang, source,
    total (its count of kept terms), lang_total, kept (terms its language keeps).
    """
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    d = docs.select(text("text").cast("binary").alias("text"), text("lang").alias("lang"),
                    text("source").alias("source"))
    partial = d.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    counts = cut(partial.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = (counts.where("term is not null").groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "lang_n"))
    kept = cut(assign_key(kept, ["lang", "term"], "id"))
    mine = cut(counts.where("term is not null").drop("docs").join(kept, ["lang", "term"])
               .select("lang", "source", "term", "id", "n", "lang_n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"),
                                     F.sum("lang_n").alias("lang_total"))
    totals = mine.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
              .join(sizes, "lang", "left").fillna(0, ["total", "kept", "lang_total"]))
    return kept, mine, cut(groups)


def pair_values(terms: DataFrame, counts: DataFrame, groups: DataFrame, block: int = BLOCK,
                tile: int = TILE) -> DataFrame:
    """From ``term_counts``: lang, a, b, value of every unordered pair of sources (a < b) of a language
    that keeps terms."""
    # A list of sources: one row each, ranked within its language.
    ranked = groups.where("kept > 0").withColumn("tile", F.floor(
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / tile).cast("int"))
    number = _div(F.col("id"), F.lit(block)).alias("block")
    held = counts.select("lang", "source", number, "id", "n")
    arrays = held.groupBy("lang", "source", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("held"))
    arrays = arrays.select("lang", "source", "block", F.col("held.id").alias("ids"),
                           F.col("held.n").alias("counts"))
    blocks = terms.groupBy("lang", number).agg(F.count(F.lit(1)).alias("size"))
    # A source without terms in a block still meets the others there.
    sides = cut(ranked.join(blocks, "lang").join(arrays, ["lang", "source", "block"], "left")
                .select("lang", "block", "tile", "source", "total", "kept", "size", "ids", "counts"))
    tiles = ranked.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    dealt = sides.join(tiles, "lang")
    left = dealt.withColumn("other", F.explode(F.sequence("tile", F.col("tiles") - 1)))
    right = dealt.withColumn("first", F.explode(F.sequence(F.lit(0), "tile")))

    def by_task(side: DataFrame, x: str, y: str):
        side = side.select("lang", "block", F.col(x).alias("x"), F.col(y).alias("y"), "source",
                           "total", "kept", "size", "ids", "counts")
        return side.toDF(*side.columns).groupBy("lang", "block", "x", "y")
    parts = by_task(left, "tile", "other").cogroup(by_task(right, "first", "tile")).applyInArrow(
        _pair_task, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: see above; ranks count from 1 per
    group and part, by falling value, then item.

    Null text, lang and source are empty strings; a group of empty texts is
    compared like any other; a language that keeps no term has value 0 for all
    its pairs; one with a single source has no pair; repeated rows count each;
    other columns are not read; an empty table gives an empty result.
    """
    terms, counts, groups = term_counts(docs, min_docs)
    values = pair_values(terms, counts, groups)
    g = groups.select("lang", "source")
    # The report has a row for every ordered pair of a language's sources.
    pairs = (g.join(g.withColumnRenamed("source", "item"), "lang").where("source <> item")
             .withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")})
             .join(values, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0)).cast("long").alias("value")))
    ranks = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    priced = (counts.join(groups, ["lang", "source"])
              .withColumns({"p": price(F.col("n"), F.col("total"), F.col("kept")),
                            "q": price(F.col("lang_n"), F.col("lang_total"), F.col("kept"))})
              .where("p > q")
              .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                      difference(F.col("p"), F.col("q")).alias("value")))
    raised = priced.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(ranks)).union(raised)


#: DuckDB twin of the query over documents.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
w AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(ln)::HUGEINT AS lt FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term)
      GROUP BY lang, source, term),
g AS (SELECT x.lang, x.source, coalesce(t.n, 0)::HUGEINT AS total, coalesce(v.v, 0) AS v, v.lt
      FROM (SELECT DISTINCT lang, source FROM d) x
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source) t USING (lang, source)
      LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
             1 + (1000000000::HUGEINT * (k.ln + 2)) // (g.lt + 2 * g.v) AS q
      FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item,
                 sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p
  WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
             ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
