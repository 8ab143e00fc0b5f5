"""Dimension builders (M1-M4).

Every dimension is small next to the events (distinct visa types, dates,
country codes, cities x races): the event-sized work is one partially
aggregated ``distinct`` per dimension, and joins run on the distinct keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions.dates import calendar_columns, sas_date
from starmart.functions.text import title_case
from starmart.operators.clean import rename_columns
from starmart.operators.joins import lookup_join
from starmart.operators.keys import assign_key


def visa_type_dim(arrivals: DataFrame) -> DataFrame:
    """M1: ``(visatype, visa_type_key)``; NULL is a member and gets key 0."""
    return assign_key(arrivals.select("visatype").distinct(), "visatype", "visa_type_key")


def calendar_dim(arrivals: DataFrame) -> DataFrame:
    """M2: one row per arrival date (NULL included) with its calendar parts."""
    return calendar_of(arrivals.select(sas_date("arrdate").alias("arrdate")))


def calendar_of(days: DataFrame) -> DataFrame:
    """M2 from typed dates (column ``arrdate``), as the fact table holds them."""
    return assign_key(days.select("arrdate").distinct().withColumns(calendar_columns("arrdate")),
                      "arrdate", "id")


def country_averages(temperatures: DataFrame) -> DataFrame:
    """Average temperature per title-cased country name (A2 on the join key).

    Sums and counts are taken per name as written (partial aggregation on
    every task), and only the per-name rows are title-cased and merged, so
    the string function runs once per spelling, not once per reading.
    """
    t = F.col("AverageTemperature")
    per_name = (temperatures.groupBy("Country")
                .agg(F.sum(t).alias("_sum"), F.count(t).alias("_n")))
    return (per_name.groupBy(title_case("Country").alias("country_name"))
            .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("average_temperature")))


def avg_by_country(temperatures: DataFrame) -> DataFrame:
    """A2: ``(Country, average_temperature)`` on the names as written."""
    return (temperatures.groupBy("Country")
            .agg(F.avg("AverageTemperature").alias("average_temperature")))


def mapping_names(mapping: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Country codes as doubles (the event type) and title-cased names.

    ``aliases`` maps a title-cased mapping name to the name the temperature
    data uses (e.g. ``{"Norland, Upper": "Norland"}``); names not in it stay.
    """
    name = title_case("Name")
    if aliases:
        lookup = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        name = F.coalesce(F.element_at(lookup, name), name)
    return mapping.select(F.col("code").cast("double").alias("country_code"),
                          name.alias("country_name"))


def country_dim(arrivals: DataFrame, mapping: DataFrame, temperatures: DataFrame,
                aliases: Mapping[str, str] | None = None) -> DataFrame:
    """M3: ``(country_code, country_name, average_temperature)``.

    One row per residence code seen in the events (NULL included); unmapped
    codes keep a NULL name.  ``distinct`` runs on the codes before the joins,
    not on an event-sized join result.
    """
    return country_of(arrivals.select(F.col("i94res").alias("country_code")), mapping,
                      temperatures, aliases)


def named_countries(codes: DataFrame, mapping: DataFrame,
                    aliases: Mapping[str, str] | None = None) -> DataFrame:
    """``(country_code, country_name)`` for the distinct codes."""
    return lookup_join(codes.select("country_code").distinct(), mapping_names(mapping, aliases),
                       "country_code", "left").distinct()


def country_of(codes: DataFrame, mapping: DataFrame, temperatures: DataFrame,
               aliases: Mapping[str, str] | None = None) -> DataFrame:
    """M3 from residence codes (column ``country_code``), repeated or not."""
    named = named_countries(codes, mapping, aliases)
    return (lookup_join(named, country_averages(temperatures), "country_name", "left", stage=True)
            .select("country_code", "country_name", "average_temperature").distinct())


def demographics_dim(demographics: DataFrame) -> DataFrame:
    """M4: renamed demographics columns plus a dense ``id`` on the row key."""
    dim = rename_columns(demographics, schemas.DEMOGRAPHICS_RENAMES)
    return assign_key(dim, ["City", "State", "state_code", "Race"], "id")
