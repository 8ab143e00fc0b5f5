"""M6-M8: the whole star in one run, and SQL views over it.

The events are read twice and written once: first for the visa types (the
fact needs their keys), then for the fact itself.  Calendar and country come
from the columns of the written fact, so no further copy of the events is
made.  Every returned table is read back from what was written, so later use
does not re-run the build, and ids cannot drift between the written and
returned copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.config import overlaps
from starmart.operators.clean import clean_arrivals, clean_demographics, clean_temperatures
from starmart.plans import dims
from starmart.plans.fact import arrivals_fact
from starmart.plans.quality import referential_checks, row_count_checks
from starmart.sources.readers import (PipelineConfig, read_csv_table, read_events, read_table,
                                      require_columns)
from starmart.sources.writers import write_table

STAR_TABLES = ("immigration_fact", "visatype", "immigration_calendar", "country", "demographics")


def build_event_tables(spark: SparkSession, arrivals: DataFrame, temperatures: DataFrame,
                       country_mapping: DataFrame, output: str,
                       temperature_order: Sequence[str] | None = None,
                       country_aliases: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """M6: clean the events, write visa type, calendar, country and fact tables."""
    out = output.rstrip("/")
    events = clean_arrivals(arrivals)
    write_table(dims.visa_type_dim(events), f"{out}/visatype")
    visa = read_table(spark, f"{out}/visatype")
    write_table(arrivals_fact(events, visa), f"{out}/immigration_fact")
    fact = read_table(spark, f"{out}/immigration_fact")

    write_table(dims.calendar_of(fact), f"{out}/immigration_calendar",
                partition_by=schemas.CALENDAR_PARTITIONS, spread_partitions=True)
    codes = fact.select(F.col("country_residence_code").alias("country_code"))
    temps = clean_temperatures(temperatures, order_by=temperature_order)
    write_table(dims.country_of(codes, country_mapping, temps, country_aliases), f"{out}/country")
    names = ("immigration_fact", "visatype", "immigration_calendar", "country")
    return {name: read_table(spark, f"{out}/{name}") for name in names}


def refuse_overlap(inputs: Sequence[str], output: str, tables: Sequence[str] = ()) -> None:
    """Raise if a table to be written lies on, in or around an input: writing
    replaces the table's folder, and with it the input being read."""
    for name in tables or STAR_TABLES:
        for p in inputs:
            if overlaps(p, f"{output.rstrip('/')}/{name}"):
                raise ValueError(f"table {name} under {output} would overwrite input {p}")


def build_demographics_table(spark: SparkSession, demographics: DataFrame, output: str,
                             demographics_order: Sequence[str] | None = None) -> DataFrame:
    """M7: clean the demographics and write their dimension."""
    path = f"{output.rstrip('/')}/demographics"
    demo = clean_demographics(demographics, order_by=demographics_order)
    write_table(dims.demographics_dim(demo), path)
    return read_table(spark, path)


def build_star(spark: SparkSession, arrivals: DataFrame, temperatures: DataFrame,
               demographics: DataFrame, country_mapping: DataFrame, output: str,
               temperature_order: Sequence[str] | None = None,
               demographics_order: Sequence[str] | None = None,
               inputs: Sequence[str] = (),
               country_aliases: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Clean the inputs, build and write the five tables under ``output``."""
    refuse_overlap(inputs, output)
    star = build_event_tables(spark, arrivals, temperatures, country_mapping, output,
                              temperature_order, country_aliases)
    star["demographics"] = build_demographics_table(spark, demographics, output,
                                                    demographics_order)
    return {name: star[name] for name in STAR_TABLES}


def read_arrivals(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                  **options) -> DataFrame:
    """Events with at least the columns the star needs, and any others they have.

    Parquet and ORC bring their types; the columns of other formats that the
    data dictionary knows are cast to its types.
    """
    if schema is None and fmt not in ("parquet", "orc"):
        found = read_events(spark, path, fmt, **options)
        known = {f.name: f.dataType for f in schemas.ARRIVALS.fields}
        events = found.withColumns({c: F.col(f"`{c}`").cast(known[c])
                                    for c in found.columns if c in known})
    else:
        events = read_events(spark, path, fmt, schema, **options)
    return require_columns(events, schemas.REQUIRED_ARRIVAL_COLUMNS, path)


def run_pipeline(spark: SparkSession, config: PipelineConfig,
                 temperature_order: Sequence[str] | None = None,
                 demographics_order: Sequence[str] | None = None,
                 checks: bool = True) -> dict[str, DataFrame]:
    """M6-M8 from files: read the four inputs as configured, build and write the
    star, and return its tables plus ``checks`` (row counts and orphans) unless
    ``checks=False``.

    Events come through any Spark data source (S1) with all the columns their
    files have; temperatures and the country mapping are comma CSV (S2),
    demographics ``;`` CSV (S3), bound by header.
    """
    refuse_overlap(config.inputs(), config.output)
    events = read_arrivals(spark, config.events, config.events_format, config.events_schema,
                           **config.events_options)
    temps = read_csv_table(spark, config.temperatures,
                           config.temperatures_schema or schemas.TEMPERATURES)
    demo = read_csv_table(spark, config.demographics,
                          config.demographics_schema or schemas.DEMOGRAPHICS, sep=";")
    mapping = read_csv_table(spark, config.country_mapping,
                             config.mapping_schema or schemas.COUNTRY_MAPPING)
    star = build_star(spark, events, temps, demo, mapping, config.output,
                      temperature_order=temperature_order,
                      demographics_order=demographics_order, inputs=config.inputs(),
                      country_aliases=config.country_aliases)
    if not checks:
        return star
    fact = star["immigration_fact"]
    counts = row_count_checks(star).select(
        F.col("table_name").alias("check_name"), F.col("n_rows").alias("value"), "passed")
    refs = referential_checks(fact, {
        "fact_country": ("country_residence_code", star["country"], "country_code"),
        "fact_visatype": ("visa_type_key", star["visatype"], "visa_type_key"),
        "fact_calendar": ("arrdate", star["immigration_calendar"], "arrdate"),
    }).select("check_name", F.col("orphans").alias("value"), "passed")
    return {**star, "checks": counts.unionByName(refs)}


def register_star(tables: Mapping[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Temp views named ``prefix + table`` for ad-hoc SQL; returns the names."""
    names = {}
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names
