"""SAS day numbers and calendar parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The SAS epoch, and the day numbers of 0001-01-01 and 9999-12-31
# relative to it (the range of Spark's DateType).
SAS_EPOCH = _dt.date(1960, 1, 1)
SAS_MIN_DAY = -715509
SAS_MAX_DAY = 2936549
_MICROS_PER_DAY = 86400000000.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sas_day_number(x) -> Column:
    """Whole days of a SAS day number as ``date + timedelta(x)`` counts them.

    The fraction is rounded to the microsecond (half to even) first, so
    -1e-12 is day 0 and -0.5 is day -1 (a floor, except within half a
    microsecond of the next midnight).
    """
    x = _col(x)
    whole = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x))
    micros = F.bround((x - whole) * F.lit(_MICROS_PER_DAY), 0)
    return whole + F.floor(micros / F.lit(_MICROS_PER_DAY))


def sas_date(x, zero_is_null: bool = True) -> Column:
    """Days since 1960-01-01 (a double) to a DATE.

    NULL, NaN and days outside year 1..9999 give NULL; so does 0 when
    ``zero_is_null`` (the original conversion tested the value for truth).
    """
    x = _col(x)
    valid = (x >= F.lit(SAS_MIN_DAY)) & (x < F.lit(SAS_MAX_DAY + 1)) & ~F.isnan(x)
    if zero_is_null:
        valid = valid & (x != F.lit(0.0))
    day = sas_day_number(x)
    valid = valid & (day >= F.lit(SAS_MIN_DAY)) & (day <= F.lit(SAS_MAX_DAY))
    return F.when(valid, F.date_add(F.lit(SAS_EPOCH), day.cast("int")))


def calendar_columns(d) -> dict[str, Column]:
    """Calendar parts of a date column, in the order the dimension stores them.

    Weekday is 1 = Sunday; week is the ISO week (so 2016-01-01 is week 53).
    """
    d = _col(d)
    return {
        "arrival_weekday": F.dayofweek(d),
        "arrival_day": F.dayofmonth(d),
        "arrival_week": F.weekofyear(d),
        "arrival_month": F.month(d),
        "arrival_year": F.year(d),
    }
