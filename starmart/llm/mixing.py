"""Mixing sources to target weights (operator 8).

Sources get weights; together they share ``share`` times all words.  A target
stops at ``max_epochs`` times its source's size, and the excess is shared again
by weight until no target is above its limit (water filling, in closed form:
in the order of limit over weight the capped sources are a prefix).

Curriculum: a source's weight changes over training time t in [0, 1] as
``w (1 + slope (2t - 1))``, whose integral is w.  Its cumulative demand is
``target (t + slope (t^2 - t))``; inverting that at the cumulative words of a
document gives the training position of each pass over it.  The stream is the
documents range-sorted by position.

A source's documents queue in md5 order of their ids, pass after pass, until
the target's words are taken; a document at the end of the queue is taken in
part, so each source gives exactly the whole words of its target.  The queue
offsets come from sums per (source, first hex digits of the md5), so a source
that holds a third of all rows is spread over thousands of ordered runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm._util import WORD, cut

WEIGHTS = (3.0, 1.0, 2.0)
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
MAX_EPOCHS = 2
#: Hex digits of the md5 that name a run: 4096 runs per source.
RUN_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, weight, slope, target).

    Sources in code-point order, null last, take the weights in turn.  The
    table has one row per source (a list somebody maintains), so its windows
    run in one task.  A source of size zero has target zero.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]),
                                   (F.col("_rank") % len(xs) + 1).cast("int"))
    s = (sizes.withColumn("_rank", F.row_number().over(order) - 1)
         .withColumn("weight", pick(weights)).withColumn("slope", pick(slopes))
         .withColumn("_limit", F.col("source_size") * F.lit(float(max_epochs))))
    # Capped sources come first by limit / weight; the level of a source is
    # what a unit of weight gets if all before it are capped and it is not.
    fill = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("_rank"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("_level",
                     (F.sum("source_size").over(everything) * F.lit(float(share))
                      - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    # That holds from the first uncapped source on, whose level is the largest.
    s = s.withColumn("_free", F.max(F.when(F.col("weight") * F.col("_level") <= F.col("_limit"),
                                           F.col("_level"))).over(everything))
    target = F.least("_limit", F.col("weight") * F.coalesce("_free", F.lit(float("inf"))))
    return s.select("source", "source_size", "weight", "slope", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, carry: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source are read).

    doc_id, source, size (words of the text; null text: 0), source_size,
    target (of its source), taken (words the mix takes, repeats counted),
    positions (array of the training times in [0, 1], one per pass that takes
    words), and with ``carry`` the whole row as struct ``row``.  A null source
    is a source.
    Rows that repeat a doc_id queue by a hash of their text; fully equal rows
    share a place in any order, which gives the same rows.  Other columns,
    whatever their names, are left out.  An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"),
                    order.alias("_order"), F.md5(F.coalesce("text", F.lit(""))).alias("_text"),
                    *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * carry)
    d = d.withColumn("_run", F.substring("_order", 1, RUN_DIGITS))
    runs = cut(d.groupBy("source", "_run").agg(F.sum("size").alias("_words")))
    targets = source_targets(runs.groupBy("source").agg(F.sum("_words").alias("source_size")),
                             weights, slopes, share, max_epochs)
    # At most 16**RUN_DIGITS rows per source.
    upto = Window.partitionBy("source").orderBy("_run")
    runs = (runs.withColumn("_offset", F.sum("_words").over(upto) - F.col("_words"))
            .join(targets.withColumnRenamed("source", "_s"),
                  F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_words"))
    runs = runs.withColumnsRenamed({"source": "_s", "_run": "_r"})
    inside = (Window.partitionBy("source", "_run").orderBy("_order", "doc_id", "_text")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_upto", F.sum("size").over(inside))
    d = d.join(runs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_run") == F.col("_r")))
    start = F.col("_offset") + F.col("_upto") - F.col("size")
    taken = lambda k: F.greatest(F.lit(0), F.least(
        F.col("size"), F.floor("target") - k * F.col("source_size") - start))
    passes = [taken(F.lit(k)) for k in range(int(-(-max_epochs // 1)))]
    times = [F.when(p > 0, _time((start + F.lit(k) * F.col("source_size") + p / 2)
                                 / F.col("target"))) for k, p in enumerate(passes)]
    total = passes[0]
    for p in passes[1:]:
        total = total + p
    return d.select("doc_id", "source", "size", "source_size", "target",
                    total.cast("long").alias("taken"),
                    F.array_compact(F.array(*times)).alias("positions"),
                    *["row"] * carry)


def _time(share: F.Column) -> F.Column:
    """The time t at which ``share`` of the source's demand has been met."""
    a = F.col("slope")
    root = F.sqrt(F.greatest(F.lit(0.0), (1 - a) * (1 - a) + 4 * a * share))
    # Root of a t^2 + (1 - a) t = share, in the form that holds for a = 0.
    return F.least(F.lit(1.0), 2 * share / ((1 - a) + root))


def training_stream(docs: DataFrame, taken: str = "_taken", position: str = "_position",
                    **options) -> DataFrame:
    """Rows of ``docs`` in training order, one per pass that takes words, with the
    words taken and the position as columns of the given names.

    A document taken twice appears twice; one without words, a null text too, does not
    appear.  The order is a range sort, so the stream is written as consecutive files.
    Columns of ``docs`` that have one of the two names are replaced; all others pass.
    Rows that repeat one another are rows of their own; an empty table gives an empty
    result.
    """
    own = {taken.lower(), position.lower()}
    passes = (mix(docs, carry=True, **options)
              .select("row", "taken", F.explode("positions").alias("_position"))
              .orderBy("_position", "row.doc_id"))
    return passes.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in own],
                         F.col("taken").alias(taken), F.col("_position").alias(position))


#: DuckDB twin of the query over documents.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o, md5(coalesce(text, '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS r
      FROM d GROUP BY source),
w AS (SELECT *, CAST([3.0, 1.0, 2.0][r % 3 + 1] AS DOUBLE) AS weight,
             CAST([-0.5, 0.0, 0.5][r % 3 + 1] AS DOUBLE) AS slope,
             2.0::DOUBLE * source_size AS lim FROM s),
f AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, r
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
             / sum(weight) OVER (ORDER BY lim / weight, r
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
t AS (SELECT source, source_size, slope,
             least(lim, weight * (SELECT coalesce(max(lev), 'inf'::DOUBLE) FROM f
                                  WHERE weight * lev <= lim)) AS target FROM f),
q AS (SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, h
             ROWS UNBOUNDED PRECEDING) - size AS b FROM d),
j AS (SELECT q.doc_id, q.size, t.source_size, t.target, t.slope, q.b,
             greatest(0, least(q.size, floor(t.target) - q.b)) AS p0,
             greatest(0, least(q.size, floor(t.target) - t.source_size - q.b)) AS p1
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(p0 + p1 AS BIGINT) AS taken,
       CASE WHEN p0 > 0 THEN round(least(1.0::DOUBLE, 2 * ((b + p0 / 2) / target) / ((1 - slope) +
         sqrt(greatest(0.0::DOUBLE, (1 - slope) * (1 - slope) + 4 * slope * ((b + p0 / 2) / target))))), 6)
         END AS position
FROM j
"""
