"""Daily update of the star: a load adds its events and only what is new to the
dimensions, and a load that is run again changes nothing.

Under ``output`` every table is partitioned by ``load_day``:

- the fact holds a load's events; writing a load replaces its own partition only
  (dynamic partition overwrite), so a rerun gives the same rows;
- visa types, calendar and residence codes are key maps.  A load appends the members
  that no load has brought before, with ids that follow on from the greatest; ids
  given once never change, whatever is loaded or rerun later.  The maps are written
  before the fact: a load that breaks off leaves members, never facts without them;
- the country dimension is a snapshot of all codes with the names and averages of the
  latest load; readers take the newest one, and older ones stay for as long as
  somebody wants them.

A load scans its own events twice (visa types, then the fact) and the key maps once.
Nothing of earlier loads is read but the maps, so its cost does not grow with the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import calendar_columns
from starmart.operators.clean import clean_arrivals, clean_temperatures
from starmart.operators.keys import extend_key
from starmart.plans import dims
from starmart.plans.fact import arrivals_fact
from starmart.sources.readers import read_table
from starmart.sources.writers import write_table

LOAD = "load_day"


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written yet."""
    try:
        return read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _in_load(df: DataFrame, load_day: str) -> DataFrame:
    return df.withColumn(LOAD, F.lit(load_day).cast("date"))


def extend_map(spark: SparkSession, path: str, members: DataFrame, key: Sequence[str],
               id_col: str | None, load_day: str) -> DataFrame:
    """Append the rows of ``members`` whose key the map at ``path`` lacks, as
    partition ``load_day``; returns the whole map.  Without new members no file
    is written.  A null is a member like any other."""
    known = existing_table(spark, path)
    new = extend_key(known, members, key, id_col)
    if known is None or not new.isEmpty():
        write_table(_in_load(new, load_day), path, partition_by=[LOAD], mode="append")
    return read_table(spark, path)


def replace_load(df: DataFrame, path: str, load_day: str) -> None:
    """Write ``df`` as partition ``load_day`` of the table at ``path``, replacing
    that partition and no other."""
    (_in_load(df, load_day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOAD).parquet(path))


def update_star(spark: SparkSession, output: str, load_day: str, arrivals: DataFrame,
                temperatures: DataFrame, country_mapping: DataFrame,
                temperature_order: Sequence[str] | None = None,
                country_aliases: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Load the events of one day (or any other unit that is loaded at once) and
    return the star.  ``load_day`` (a date, YYYY-MM-DD) names the load: run again, it
    replaces what it wrote."""
    out = output.rstrip("/")
    events = clean_arrivals(arrivals)
    visa = extend_map(spark, f"{out}/visatype", events.select("visatype").distinct(),
                      ["visatype"], "visa_type_key", load_day)
    fact = arrivals_fact(events, visa.drop(LOAD)).checkpoint(eager=True)
    days = fact.select("arrdate").distinct().withColumns(calendar_columns("arrdate"))
    extend_map(spark, f"{out}/immigration_calendar", days, ["arrdate"], "id", load_day)
    codes = extend_map(spark, f"{out}/country_code", fact.select(
        F.col("country_residence_code").alias("country_code")).distinct(), ["country_code"], None,
        load_day)
    latest = codes.agg(F.max(LOAD)).first()[0]
    snapshots = existing_table(spark, f"{out}/country")
    if snapshots is not None:
        latest = max(latest, snapshots.agg(F.max(LOAD)).first()[0])
    temps = clean_temperatures(temperatures, order_by=temperature_order)
    replace_load(dims.country_of(codes.drop(LOAD), country_mapping, temps, country_aliases),
                 f"{out}/country", max(load_day, str(latest)))
    replace_load(fact, f"{out}/immigration_fact", load_day)
    return read_star(spark, out)


def read_star(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The tables of the star as of the latest load; the fact keeps ``load_day``."""
    out = output.rstrip("/")
    country = read_table(spark, f"{out}/country")
    newest = country.agg(F.max(LOAD)).first()[0]
    return {"immigration_fact": read_table(spark, f"{out}/immigration_fact"),
            "visatype": read_table(spark, f"{out}/visatype").drop(LOAD),
            "immigration_calendar": read_table(spark, f"{out}/immigration_calendar").drop(LOAD),
            "country": country.where(F.col(LOAD) == F.lit(newest)).drop(LOAD)}
