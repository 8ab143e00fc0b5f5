"""Entry points with the roles and arguments of the original job's functions,
so a driver written for it can switch to starmart unchanged.

Each delegates to the starmart builders, so the semantics are starmart's
checks returned as DataFrames.  Tables are written where the original wrote
them (``output_path + name``) and returned as read back.  Events are read with
any Spark data source (``events_format``); the SAS binary reader is not
included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart import schemas
from starmart.operators import clean as C
from starmart.operators.profile import missing_profile
from starmart.plans import dims
from starmart.plans.fact import arrivals_fact
from starmart.plans.pipeline import (build_demographics_table, build_event_tables, read_arrivals,
                                     refuse_overlap)
from starmart.plans.quality import referential_checks, row_count_checks
from starmart.sources.readers import read_csv_table, read_table
from starmart.sources.writers import write_table


def _path(base: str, name: str) -> str:
    return base + name if base.endswith("/") else f"{base}/{name}"


# ---------------------------------------------------------------- cleaning / profiling

def clean_immigration_df(df: DataFrame) -> DataFrame:
    return C.clean_arrivals(df)


def clean_temperatures_df(df: DataFrame, order_by=None) -> DataFrame:
    return C.clean_temperatures(df, order_by=order_by)


def aggregate_temperatures_df(temperatures_df: DataFrame) -> DataFrame:
    return dims.avg_by_country(temperatures_df)


def clean_demographics_df(df: DataFrame, order_by=None) -> DataFrame:
    return C.clean_demographics(df, order_by=order_by)


def missing_values_spark(df: DataFrame) -> DataFrame:
    """The numbers behind the original missing-value chart: cols, values, pct."""
    return missing_profile(df)


# ---------------------------------------------------------------- dimensions and fact

def create_visa_type_df(df: DataFrame, output_path: str) -> DataFrame:
    path = _path(output_path, "visatype")
    write_table(dims.visa_type_dim(df), path)
    return read_table(df.sparkSession, path)


def get_visa_type_dimension(spark: SparkSession, output_data: str) -> DataFrame:
    return read_table(spark, _path(output_data, "visatype"))


def create_immigration_time_df(df: DataFrame, output_path: str) -> DataFrame:
    path = _path(output_path, "immigration_calendar")
    write_table(dims.calendar_dim(df), path, partition_by=schemas.CALENDAR_PARTITIONS,
                spread_partitions=True)
    return read_table(df.sparkSession, path)


def create_countries_df(spark: SparkSession, immigrations_df: DataFrame,
                        temperatures_df: DataFrame, output_path: str,
                        countries_mapping_df: DataFrame) -> DataFrame:
    path = _path(output_path, "country")
    write_table(dims.country_dim(immigrations_df, countries_mapping_df, temperatures_df), path)
    return read_table(spark, path)


def create_immigration_fact_table(spark: SparkSession, df: DataFrame,
                                  output_data: str) -> DataFrame:
    """Needs the visa type table already written under ``output_data``."""
    path = _path(output_data, "immigration_fact")
    write_table(arrivals_fact(df, get_visa_type_dimension(spark, output_data)), path)
    return read_table(spark, path)


def create_demographics_dimension_table(demographics_df: DataFrame,
                                        output_data: str) -> DataFrame:
    path = _path(output_data, "demographics")
    write_table(dims.demographics_dim(demographics_df), path)
    return read_table(demographics_df.sparkSession, path)


# ---------------------------------------------------------------- pipelines and checks

def process_input_data(spark: SparkSession, input_path: str, output_path: str,
                       immigration_file_name: str, temperature_file_name: str,
                       countries_mapping_df: DataFrame, events_format: str = "parquet",
                       events_schema=None, temperatures_schema=None,
                       temperature_order=None, **options) -> dict[str, DataFrame]:
    """Events and temperatures -> visa type, calendar, country and fact tables.

    ``options`` go to the reader of the events (a CSV has a header by default).
    """
    paths = [_path(input_path, f) for f in (immigration_file_name, temperature_file_name)]
    refuse_overlap(paths, output_path)
    events = read_arrivals(spark, paths[0], events_format, events_schema, **options)
    temps = read_csv_table(spark, paths[1], temperatures_schema or schemas.TEMPERATURES)
    return build_event_tables(spark, events, temps, countries_mapping_df, output_path,
                              temperature_order)


def process_demographics_data(spark: SparkSession, input_path: str, output_path: str,
                              demographics_file_name: str, demographics_schema=None,
                              demographics_order=None) -> DataFrame:
    path = _path(input_path, demographics_file_name)
    refuse_overlap([path], output_path, ["demographics"])
    demo = read_csv_table(spark, path, demographics_schema or schemas.DEMOGRAPHICS, sep=";")
    return build_demographics_table(spark, demo, output_path, demographics_order)


def count_check(df: DataFrame, label: str) -> DataFrame:
    """``(table_name, n_rows, passed)``; passes when the table is not empty."""
    return row_count_checks({label: df})


def do_quality_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the fact, visa type and country tables, and fact rows whose
    residence code has no country row: ``(check_name, value, passed)``."""
    from pyspark.sql import functions as F
    counts = row_count_checks({k: tables[k] for k in ("immigration_fact", "visatype", "country")})
    refs = referential_checks(tables["immigration_fact"], {
        "fact_country": ("country_residence_code", tables["country"], "country_code")})
    return (counts.select(F.col("table_name").alias("check_name"),
                          F.col("n_rows").alias("value"), "passed")
            .unionByName(refs.select("check_name", F.col("orphans").alias("value"), "passed")))
