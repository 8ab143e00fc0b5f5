"""Connected components of an edge table, by alternating star contractions.

Each round links every node's larger neighbours to its smallest neighbour
(large star) and then every node's smaller neighbours to the smallest (small
star).  Edges only ever move towards smaller ids, so after a logarithmic
number of rounds each component is one star around its smallest id.  Only two
numbers per round reach the driver: the edge count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm._util import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (u, v) with u > v."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    low = (both.groupBy("u").agg(F.min("v").alias("m"))
           .select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
    met = both.join(low, both["u"] == low["w"])
    if large:  # larger neighbours hang on the smallest id around u
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:      # u and its smaller neighbours hang on the smallest of them
        out = (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(low.select(F.col("w").alias("u"), F.col("m").alias("v"))))
    return out.where("u > v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge to another node.

    ``component`` is the smallest node reachable.  Loops and null ends are
    ignored, repeated edges count once; without edges the result is empty.
    """
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = cut(ends.select(F.greatest(a, b).cast("long").alias("u"),
                            F.least(a, b).cast("long").alias("v")).distinct())
    before = None
    while True:
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                    .first())
        if now == before or not now[0]:
            break
        before = now
        # A round at most doubles the edges.
        links = cut(_star(_star(links, True), False), 2 * now[0])
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
