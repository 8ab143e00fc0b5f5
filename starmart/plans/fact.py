"""M5: the immigration fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions.dates import sas_date
from starmart.operators.clean import q, rename_columns
from starmart.operators.joins import lookup_join


def typed_arrivals(arrivals: DataFrame) -> DataFrame:
    """Cleaned events under the model's names, with a typed arrival date."""
    return (rename_columns(arrivals, schemas.FACT_RENAMES)
            .withColumn("arrdate", sas_date("arrdate")))


def arrivals_fact(arrivals: DataFrame, visa_dim: DataFrame) -> DataFrame:
    """Cleaned events -> model names, visa key looked up, arrival date typed.

    Columns keep their order; ``visatype`` is replaced by ``visa_type_key``
    (NULL for a NULL visa type: NULL never joins).  The event side streams
    past the visa dimension, a handful of rows whose size is checked.
    """
    ev = typed_arrivals(arrivals)
    keys = visa_dim.select(F.col("visatype").alias("_vt"), "visa_type_key")
    joined = lookup_join(ev, keys, ev["visatype"] == keys["_vt"], "left", stage=True)
    return joined.select(*[q(c) for c in ev.columns if c != "visatype"], "visa_type_key")
