"""H5: dense, reproducible surrogate keys.

``monotonically_increasing_id`` leaves gaps and changes with the partition
layout.  Here ids are ``0..n-1`` in key order, the same for any partition
count, computed without moving all rows into one task:

1. range-partition on the key and sort each partition (without a fixed
   count AQE sizes the partitions from the data, so a small dimension
   becomes one partition and a large key set stays spread);
2. checkpoint, so both passes below see the same partitions (range bounds
   are sampled and could differ on a second evaluation);
3. count rows per partition (one row per partition), turn the counts into
   running offsets, and broadcast them (bounded by the partition count);
4. id = offset of the partition + position inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.clean import q

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def assign_key(df: DataFrame, key: Sequence[str] | str, id_col: str = "id",
               num_partitions: int | None = None) -> DataFrame:
    """Append ``id_col``: the 0-based rank of each row in ``key`` order.

    NULLs sort first.  ``key`` should be unique (callers pass distinct rows);
    equal keys still get distinct ids, in an unspecified order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    staged = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    pos = F.monotonically_increasing_id()
    located = staged.select("*", F.shiftright(pos, _LOCAL_BITS).alias("_part"),
                            (pos.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))).alias("_pos"))
    sizes = located.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-task window over it is bounded.
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    out = located.join(F.broadcast(offsets), "_part", "inner")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("_offset") + F.col("_pos")).alias(id_col))


def extend_key(known: DataFrame | None, members: DataFrame, key: Sequence[str] | str,
               id_col: str | None = "id", num_partitions: int | None = None) -> DataFrame:
    """The rows of ``members`` (distinct ``key``) that the key map ``known`` lacks, with
    ids that follow on from its greatest one, in ``key`` order; NULL is a key.

    Ids of ``known`` never change.  Without a map (None) ids count from 0; without an
    ``id_col`` the new members are returned as they are.
    """
    keys = [key] if isinstance(key, str) else list(key)
    base = 0
    if known is not None:
        have = known.select(*[q(k).alias(f"_{i}") for i, k in enumerate(keys)])
        same = [q(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
        members = members.join(have, same, "left_anti")
        if id_col:
            base = known.agg(F.coalesce(F.max(q(id_col)) + 1, F.lit(0))).first()[0]
    if not id_col:
        return members
    out = assign_key(members, keys, id_col, num_partitions)
    return out.withColumn(id_col, F.col(f"`{id_col}`") + F.lit(base))
