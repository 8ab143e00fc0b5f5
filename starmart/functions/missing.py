"""Type-aware "missing value" predicate.

Floating columns: NULL or NaN.  Strings: NULL or text that parses to NaN
(the old ``isnan`` rule, kept without failing under ANSI mode).  Every other
type: NULL only, so date columns need no cast first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(dtype, T.StringType):
        return c.isNull() | F.coalesce(F.isnan(c.try_cast("double")), F.lit(False))
    return c.isNull()
