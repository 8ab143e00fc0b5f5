"""Line dedup by a segment-partition edit join (operator 1), DataFrame
functions only.

A line goes when its text stands earlier (document, then line), or when an
earlier line is within ``max_edits`` insertions, deletions and replacements of
code points.  Lines under ``min_chars`` code points always stay: too short to
say that one is a copy.

Join: lines are split into ``max_edits + 1`` segments; a pair within that many
edits shares a segment.  A line posts its own segments under (length, segment
number, segment) and probes, for every length up to ``max_edits`` shorter, the
substrings that can align with such a segment.  Only hashes of keys and lines
are shuffled; the texts of lines that meet another are fetched afterwards.
Candidates are verified with a banded bit-parallel edit distance: one machine
word holds the vertical differences of the 2k + 1 diagonals around the main
one, moved along the shorter text (after common ends are cut off).

Hot segments: a key that many lines share (a template's fixed half) is not
expanded into pairs.  Its lines are split again: what is left of each line
without the shared segment is cut into segments under the shared key, and so
on, until keys are short lists.  A pair within the threshold shares a segment
of the rest, too, so none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import cut
from starmart.sources.writers import delete_path

MAX_EDITS = 1
MIN_CHARS = 20
#: A key of more lines than this (own times all, squared) is split again.
SHORT_LIST = 64
#: Each round at least halves what is left of a line; after the last one all
#: keys are expanded (what still differs is a character or two).
ROUNDS = 12

_OWN, _PROBE = 1, 2


# ----------------------------------------------------------- segments and probes

def _specs(k: int) -> list[tuple[int, int, int, int]]:
    """(length difference, segment from 1, shift of the start, roles) of all
    keys of a line.  The shifts are those after which the edits left of the
    segment stay under its number and those right of it under the rest."""
    out = []
    for delta in range(k + 1):
        for i in range(1, k + 2):
            low = max(-(i - 1), delta - (k + 1 - i))
            high = min(i - 1, delta + (k + 1 - i))
            out += [(delta, i, off, _OWN | _PROBE if not delta and not off else _PROBE)
                    for off in range(low, high + 1)]
    return out


def _place(n: Column, k: int, spec) -> tuple[Column, Column]:
    """(start from 0, length) of a spec's substring in a line of length n."""
    delta, i, off, _ = spec
    length = n - F.lit(delta)
    base, left = F.floor(length / (k + 1)), length % (k + 1)
    wide = k + 1 - left  # segments from this one on are a character longer
    start = F.lit(i - 1) * base + F.greatest(F.lit(0), F.lit(i - 1) - wide) + F.lit(off)
    return start.cast("int"), (base + (F.lit(i - 1) >= wide).cast("int")).cast("int")


def _key(text: Column, n: Column, k: int, spec, *context: Column) -> Column:
    """Hash of (context, indexed length, segment number, substring), or null."""
    start, width = _place(n, k, spec)
    fits = (start >= 0) & (start + width <= n) & (n >= spec[0])
    return F.when(fits, F.xxhash64(*context, n - F.lit(spec[0]), F.lit(spec[1]),
                                   F.substring(text, start + 1, width)))


# ------------------------------------------------------------- verified distance

def _common(a: Column, b: Column, most: int = 1 << 16) -> Column:
    """Length of the common prefix, by halving steps."""
    steps = [1 << e for e in range(most.bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= F.least(F.length(a), F.length(b)))
                             & (F.substring(a, at + 1, s) == F.substring(b, at + 1, s)), at + s)
        .otherwise(at))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def within(a: Column, b: Column, k: int) -> Column:
    """Whether the edit distance of two strings is at most ``k``."""
    def rest(s):  # both strings without their common prefix, reversed
        cut_ = lambda x: F.reverse(F.substring(x, s + 1, F.length(x)))
        return _let(F.struct(cut_(a).alias("a"), cut_(b).alias("b")), middle)

    def middle(s):  # and without their common suffix, as characters
        return _let(_common(s["a"], s["b"]), lambda c: _let(F.struct(
            F.split(F.substring(s["a"], c + 1, F.length(s["a"])), "").alias("p"),
            F.split(F.substring(s["b"], c + 1, F.length(s["b"])), "").alias("t"),
            (F.length(s["a"]) - c).alias("m"), (F.length(s["b"]) - c).alias("n")), verdict))

    def verdict(s):
        return F.when((s["m"] == 0) | (s["n"] == 0), F.greatest(s["m"], s["n"]) <= k).otherwise(
            _banded(s["p"], s["t"], s["m"], s["n"], k) <= k)
    return F.when(F.abs(F.length(a) - F.length(b)) > k, False).otherwise(
        _let(_common(a, b), rest))


def _banded(p: Column, t: Column, m: Column, n: Column, k: int) -> Column:
    """Bit-parallel edit distance in a band of 2k + 1 diagonals; exact up to k.

    Bit b of column j stands for row j - k + b.  Rows from 0 upwards continue
    as if each step up cost one, which keeps row 0 at its true value j.  The
    distance is followed along the diagonal that ends in the last cell: it
    grows by one in each column whose diagonal difference bit is not set.
    """
    full = F.lit((1 << 2 * k + 1) - 1).cast("long")
    one = lambda b: F.lit(1 << b).cast("long")
    inverse = lambda x: F.bitwise_not(x).bitwiseAND(full)

    def step(s, j):
        c = F.get(t, j - 1)
        eq = None
        for b in range(2 * k + 1):
            bit = F.when(F.get(p, j - k + b - 1) == c, one(b)).otherwise(F.lit(0).cast("long"))
            eq = bit if eq is None else eq.bitwiseOR(bit)
        vp, vn = s["vp"], s["vn"]

        def column(e):
            d0 = ((e.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(e).bitwiseOR(vn).bitwiseAND(full)
            return _let(d0, after)

        def after(d0):
            hp = vn.bitwiseOR(inverse(d0.bitwiseOR(vp)))
            hn = d0.bitwiseAND(vp)
            d1 = F.shiftright(d0, 1)
            same = F.call_function("shiftright", d0, m - n + k).bitwiseAND(one(0)).cast("int")
            return F.struct(hn.bitwiseOR(inverse(d1.bitwiseOR(hp))).alias("vp"),
                            d1.bitwiseAND(hp).alias("vn"),
                            (s["d"] + F.when(j > n - m, 1 - same).otherwise(0)).alias("d"))
        return _let(eq, column)

    start = F.struct(F.lit(((1 << k + 1) - 1) << k).cast("long").alias("vp"),
                     F.lit((1 << k) - 1).cast("long").alias("vn"), F.abs(m - n).alias("d"))
    return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["d"])


# -------------------------------------------------------------------- line tables

_PER_DOC = 1 << 32


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Lines that can be copies: (doc_id, doc, line_no, line, n, h1, h2, place).

    ``doc`` is a hash of the text, to tell rows that repeat a doc_id apart;
    ``place`` orders lines by document, then line.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    x = d.select("doc_id", F.xxhash64("text").alias("doc"),
                 F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    x = x.select("doc_id", "doc", "line_no", F.btrim("raw", F.lit(" \t\r\f\u000b")).alias("line"))
    x = x.withColumn("n", F.length("line")).where(F.col("n") >= min_chars)
    return x.withColumns({
        "h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line"),
        "place": F.col("doc_id").cast("decimal(20,0)").cast("decimal(38,0)") * F.lit(_PER_DOC).cast(
            "decimal(11,0)") + F.col("line_no").cast("decimal(11,0)")}).withColumn(
        "place", F.col("place").cast("decimal(38,0)"))


def _shared(keys: DataFrame) -> DataFrame:
    """Rows of the keys under which an own segment meets another line."""
    met = (keys.groupBy("key").agg(F.count(F.lit(1)).alias("met"),
                                   F.sum(F.col("roles").bitwiseAND(_OWN)).alias("own"))
           .where("own >= 1 and met >= 2").withColumnRenamed("key", "_key"))
    return keys.join(met, keys["key"] == met["_key"]).drop("_key")


def _pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs (a1, a2, b1, b2) under shared keys, each once."""
    a = (members.where(F.col("roles").bitwiseAND(_OWN) != 0)
         .select("key", F.col("h1").alias("a1"), F.col("h2").alias("a2")))
    b = (members.where(F.col("roles").bitwiseAND(_PROBE) != 0)
         .select(F.col("key").alias("_key"), F.col("h1").alias("b1"), F.col("h2").alias("b2")))
    met = a.join(b, (F.col("key") == F.col("_key")) & ((F.col("a1") != F.col("b1"))
                                                       | (F.col("a2") != F.col("b2"))))
    x, y = (F.struct(F.col(f"{s}1").alias("h1"), F.col(f"{s}2").alias("h2")) for s in "ab")
    low, high = F.least(x, y), F.greatest(x, y)
    return met.select(low["h1"].alias("a1"), low["h2"].alias("a2"),
                      high["h1"].alias("b1"), high["h2"].alias("b2")).distinct()


def _near(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(h1, h2) of the later line of each pair within ``k`` edits."""
    side = lambda s: texts.select(
        F.col("h1").alias(f"_{s}1"), F.col("h2").alias(f"_{s}2"),
        F.col("line").alias(f"{s}_line"), F.col("place").alias(f"{s}_place"))
    both = (pairs.join(side("a"), (F.col("a1") == F.col("_a1")) & (F.col("a2") == F.col("_a2")))
            .join(side("b"), (F.col("b1") == F.col("_b1")) & (F.col("b2") == F.col("_b2"))))
    close = both.where(within(F.col("a_line"), F.col("b_line"), k))
    first = F.struct("a_place", "a_line") < F.struct(F.col("b_place").alias("a_place"),
                                                     F.col("b_line").alias("a_line"))
    return close.select(F.when(first, F.col("b1")).otherwise(F.col("a1")).alias("h1"),
                        F.when(first, F.col("b2")).otherwise(F.col("a2")).alias("h2")).distinct()


#: Low bits of a line's hash that the prefilter of the text fetch keeps; at
#: most 2**20 numbers are broadcast.
_FILTER = (1 << 20) - 1


def _classes(lines: DataFrame, k: int) -> DataFrame:
    """One row per different line: h1, h2, first and last place, n, keys."""
    names = [f"k{i}" for i in range(len(_specs(k)))]
    hashed = lines.select("h1", "h2", "n", "place", *[
        _key(F.col("line"), F.col("n"), k, s).alias(c) for c, s in zip(names, _specs(k))])
    return hashed.groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.min("n").alias("n"),
        *[F.min(c).alias(c) for c in names])


def _texts(lines: DataFrame, members: DataFrame) -> DataFrame:
    """(h1, h2, place, line) of the lines that met another.

    A prefilter on a few bits of the hash, of bounded size, spares most lines
    the shuffle while few lines meet; the join after it decides.
    """
    met = cut(members.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).distinct())
    bits = met.select(F.col("_h1").bitwiseAND(F.lit(_FILTER)).alias("_bits")).distinct()
    likely = lines.select("h1", "h2", "line", "place").join(
        F.broadcast(bits), F.col("h1").bitwiseAND(F.lit(_FILTER)) == F.col("_bits"), "left_semi")
    likely = likely.groupBy("h1", "h2").agg(F.min("place").alias("place"),
                                            F.first("line").alias("line"))
    return cut(likely.join(met, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")),
                           "left_semi"))


def _near_copies(lines: DataFrame, classes: DataFrame, k: int, short_list: int) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within ``k`` edits."""
    specs = _specs(k)
    keys = classes.select("h1", "h2", "n", F.explode(F.array(*[
        F.struct(F.col(f"k{i}").alias("key"), F.lit(i).alias("spec"), F.lit(s[3]).alias("roles"))
        for i, s in enumerate(specs)])).alias("x")).select(
        "h1", "h2", "n", "x.key", "x.spec", "x.roles").where("key is not null")
    members = cut(_shared(keys))
    texts = _texts(lines, members)
    hot = F.col("own") * F.col("met") > short_list * short_list
    near = _near(_pairs(members.where(~hot)), texts, k)
    open_ = members.where(hot)
    if not open_.isEmpty():
        # Position of each member's segment, to leave it out of the rest.
        at = F.coalesce(*[F.when(F.col("spec") == i, F.struct(*[
            c.alias(x) for c, x in zip(_place(F.col("n"), k, s), ("start", "width"))]))
            for i, s in enumerate(specs)])
        delta = F.element_at(F.array(*[F.lit(s[0]) for s in specs]), F.col("spec") + 1)
        named = texts.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "line")
        states = (open_.withColumn("at", at).withColumn("delta", delta)
                  .join(named, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
                  .select("h1", "h2", F.col("key").alias("context"), "roles", "delta",
                          _rest(F.col("line"), F.col("at")).alias("rest")))
        for r in range(ROUNDS):
            members = cut(_shared(_split_again(states, k, specs)))
            last = r == ROUNDS - 1
            near = near.union(_near(_pairs(members if last else members.where(~hot)), texts, k))
            open_ = members.where(hot)
            if last or open_.isEmpty():
                break
            states = open_.select("h1", "h2", F.col("key").alias("context"), "roles", "delta",
                                  "rest")
    return near.distinct()


def _rest(line: Column, at: Column) -> Column:
    """A line without the substring it shares."""
    return F.concat(F.substring(line, F.lit(1), at["start"]),
                    F.substring(line, at["start"] + at["width"] + 1, F.length(line)))


def _split_again(states: DataFrame, k: int, specs) -> DataFrame:
    """Keys of the rests under their shared key; a rest keeps its length
    difference and plays at most the roles it had."""
    n = F.length("rest")
    each = [F.when((F.col("delta") == s[0]) & (F.col("roles").bitwiseAND(s[3]) != 0), F.struct(
        _key(F.col("rest"), n, k, s, F.col("context")).alias("key"),
        F.col("roles").bitwiseAND(s[3]).alias("roles"),
        F.struct(*[c.alias(x) for c, x in zip(_place(n, k, s), ("start", "width"))]).alias("at")))
        for s in specs]
    out = states.withColumn("x", F.explode(F.array_compact(F.array(*each)))).where(
        "x.key is not null")
    return out.select("h1", "h2", "x.key", "x.roles", "delta",
                      _rest(F.col("rest"), F.col("x.at")).alias("rest"))


# ----------------------------------------------------------------------- decisions

def copied_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                 short_list: int = SHORT_LIST) -> DataFrame:
    """Lines that go: (doc_id, doc, line_no, near); ``doc`` is xxhash64(text).

    ``near`` tells lines with an earlier line within ``max_edits`` from later
    copies of a line that itself stays.
    """
    from starmart.config import scratch_path
    lines, spark = _lines(docs, min_chars), docs.sparkSession
    path = scratch_path(spark, "line_classes")
    _classes(lines, max_edits).write.parquet(path)
    classes = spark.read.parquet(path)
    near = (_near_copies(lines, classes, max_edits, short_list)
            .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.lit(True).alias("_near")))
    marks = cut(classes.join(near, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")),
                             "left").where("_near or first < last")
                .select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), "first",
                        F.coalesce("_near", F.lit(False)).alias("near")))
    delete_path(spark, path)
    at = lines.select("doc_id", "doc", "line_no", "h1", "h2", "place")
    return (at.join(marks, (F.col("h1") == F.col("m1")) & (F.col("h2") == F.col("m2")))
            .where("near or place > first").select("doc_id", "doc", "line_no", "near"))


def line_report(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                short_list: int = SHORT_LIST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_exact and n_near (lines
    that go) and dropped (their numbers from 0, ascending, comma-joined).

    A null text has no lines, an empty text one.  Documents without a doc_id
    are not judged and nothing is a copy of them; rows that repeat a document
    are judged alike.  Only doc_id and text are read; an empty table gives an
    empty result.
    """
    gone = (copied_lines(docs, max_edits, min_chars, short_list).distinct()
            .groupBy("doc_id", "doc").agg(
        F.count_if(~F.col("near")).alias("n_exact"), F.count_if("near").alias("n_near"),
        F.array_sort(F.collect_list("line_no")).alias("gone"))
        .withColumnsRenamed({"doc_id": "_id", "doc": "_doc"}))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("doc"),
                       F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("_size"),
                       F.col("text").isNull().alias("_null"))
    return rows.join(gone, (F.col("doc_id") == F.col("_id")) & (F.col("doc") == F.col("_doc")),
                     "left").select(
        "doc_id", F.when(F.col("_null"), 0).otherwise(F.col("_size")).cast("long").alias("n_lines"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_exact", "n_near")],
        F.coalesce(F.array_join(F.transform("gone", lambda x: x.cast("string")), ","), F.lit(""))
        .alias("dropped"))


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                short_list: int = SHORT_LIST) -> DataFrame:
    """``docs`` with the copied lines taken out of ``text``.

    Documents of which no line with a word is left, though lines went, go too:
    all they said stands elsewhere.  Other columns pass unchanged, whatever their
    names.  Null and empty texts stay, as do rows without a doc_id, whose lines are
    not judged; rows that repeat a document lose the same lines; an empty table gives
    an empty result.
    """
    gone = (copied_lines(docs, max_edits, min_chars, short_list)
            .groupBy("doc_id", "doc").agg(F.collect_set("line_no").alias("_gone"))
            .withColumnsRenamed({"doc_id": "_id", "doc": "_doc"}))
    text = F.col("_row.text")
    rest = F.array_join(F.transform(F.filter(F.transform(
        F.split(text, "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda s: ~F.array_contains("_gone", s["i"])), lambda s: s["x"]), "\n")
    # The row travels as one column, so no name of its own can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    joined = rows.join(gone, (F.col("_row.doc_id") == F.col("_id"))
                       & (F.xxhash64("_row.text") == F.col("_doc")), "left")
    kept = F.when(F.col("_gone").isNull(), text).otherwise(rest)
    out = joined.select("_row", "_gone", kept.alias("_text"))
    return out.where(F.col("_gone").isNull() | (F.length(F.trim("_text")) > 0)).select(
        *[F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c)
          for c in docs.columns])


def oracle_sql(min_chars: int = MIN_CHARS) -> str:
    """DuckDB twin of the report for one edit: lines that agree in their first
    or last half, compared at every place where the edit can be."""
    return f"""
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, i - 1 AS line_no,
             trim(parts[i], ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS line
      FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM p)),
c AS (SELECT line, min((doc_id, line_no)) AS place, length(line) AS n
      FROM l WHERE length(line) >= {min_chars} GROUP BY line),
k AS (SELECT line, place, n, s, s // 2 AS h FROM (SELECT *, n AS s FROM c UNION ALL
      SELECT *, n - 1 AS s FROM c)),
m AS (SELECT x.line AS a, y.line AS b, x.place AS ap, y.place AS bp, x.n AS an, y.n AS bn
      FROM k x JOIN k y ON x.s = y.s AND x.n = x.s AND left(x.line, x.h) = left(y.line, y.h)
      WHERE x.line <> y.line
      UNION SELECT x.line, y.line, x.place, y.place, x.n, y.n
      FROM k x JOIN k y ON x.s = y.s AND x.n = x.s
           AND right(x.line, x.s - x.h) = right(y.line, y.s - y.h)
      WHERE x.line <> y.line),
e AS (SELECT * FROM m WHERE len(list_filter(range(0, bn), lambda i: left(a, i) = left(b, i)
      AND substr(a, i + 1 + CAST(an = bn AS INTEGER)) = substr(b, i + 2))) > 0),
near AS (SELECT DISTINCT CASE WHEN (ap, a) < (bp, b) THEN b ELSE a END AS line FROM e),
g AS (SELECT l.doc_id, l.line_no, near.line IS NOT NULL AS near
      FROM l JOIN c USING (line) LEFT JOIN near USING (line)
      WHERE near.line IS NOT NULL OR (l.doc_id, l.line_no) > c.place),
r AS (SELECT doc_id, count(*) FILTER (NOT near) AS n_exact, count(*) FILTER (near) AS n_near,
             string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS dropped
      FROM g GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines,
       coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near, coalesce(dropped, '') AS dropped
FROM p LEFT JOIN r USING (doc_id)"""
