"""Nested payloads: JSON text parsed by a schema, with a reason for every row that is not.

Every row that comes in goes out once from ``parse_payloads``, parsed or rejected;
``exploded`` turns a list inside the payload into rows without losing those whose list
is empty or missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.clean import q

_CORRUPT = "_corrupt"


def parse_payloads(df: DataFrame, column: str, schema: T.StructType,
                   required: Sequence[str] = (), payload: str = "payload") -> DataFrame:
    """``df`` with the parsed struct ``payload`` and ``reason``, null for a parsed row:

    - ``empty``: the text is null or blank;
    - ``malformed``: no JSON object, or a value that does not fit its type;
    - ``missing <field>``: the first field of ``required`` that is absent or null.

    A rejected row has no payload and keeps its text.  Fields that the schema does not
    know are ignored.
    """
    clash = [c for c in (payload, "reason") if c in df.columns]
    if clash:
        raise ValueError(f"rename the columns {clash}")
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(q(column), full, {"mode": "PERMISSIVE",
                                           "columnNameOfCorruptRecord": _CORRUPT})
    fields = F.struct(*[F.col(f"_parsed.`{f.name}`").alias(f.name) for f in schema.fields])
    reason = F.when(q(column).isNull() | (F.trim(q(column)) == ""), F.lit("empty")).when(
        F.col("_parsed").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull(), F.lit("malformed"))
    for name in required:
        reason = reason.when(F.col(f"_parsed.`{name}`").isNull(), F.lit(f"missing {name}"))
    return (df.withColumn("_parsed", parsed).withColumn("reason", reason)
            .withColumn(payload, F.when(F.col("reason").isNull(), fields)).drop("_parsed"))


def split_rejects(parsed: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Rows of ``parse_payloads`` as (parsed rows, quarantine): the first without a
    reason, the second without a payload."""
    return (parsed.where("reason IS NULL").drop("reason"),
            parsed.where("reason IS NOT NULL").drop(payload))


def exploded(df: DataFrame, items: str, item: str = "item") -> DataFrame:
    """One row per element of the list ``items`` (a column or a field of a struct), and
    one with a null ``item`` and ``item_no`` for a row whose list is empty or null."""
    return df.select("*", F.posexplode_outer(F.col(items)).alias("item_no", item))
