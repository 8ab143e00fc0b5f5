"""Named queries over the driver's tables: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Queries that
write (sources, sinks, the pipeline) stage under the shared folder of
``spark.checkpoint.dir``.  ``oracle_sql.py`` holds the DuckDB twin of each.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.config import scratch_path
from starmart.functions.dates import calendar_columns, sas_date
from starmart.functions.text import title_case
from starmart.operators import clean as C
from starmart.operators import profile as P
from starmart.operators.asof import asof_join
from starmart.operators.intervals import interval_join
from starmart.operators.joins import lookup_join, orphans
from starmart.operators.keys import assign_key
from starmart.operators.reconcile import reconcile
from starmart.operators.rollup import distinct_rollup
from starmart.plans import analytics as A
from starmart.plans import dims as M
from starmart.plans.fact import arrivals_fact, typed_arrivals
from starmart.plans.history import update_history
from starmart.plans.incremental import update_star
from starmart.plans.pipeline import read_arrivals, register_star, run_pipeline
from starmart.plans.presence import presence_by_day
from starmart.plans.quality import referential_checks, row_count_checks
from starmart.plans.sketches import daily_states, merged_counts, save_states, standard_error
from starmart.sources import bindings as B
from starmart.sources.payloads import exploded, parse_payloads
from starmart.sources.readers import PipelineConfig, read_csv_table, read_events, read_table
from starmart.sources.writers import write_table
from starmart.streaming.dedup import ingest_events, outcomes
from starmart.streaming.ingest import ingest_arrivals
from starmart.streaming.windows import stream_weekly_arrivals

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- shared inputs

def _arrivals(spark, d):
    return B.arrivals(spark, d)


def _clean_arrivals(spark, d):
    return C.clean_arrivals(B.arrivals(spark, d))


def _clean_temperatures(spark, d):
    return C.clean_temperatures(B.temperatures(spark, d), order_by=B.TEMPERATURE_TIEBREAK)


def _clean_demographics(spark, d):
    return C.clean_demographics(B.demographics(spark, d), order_by=B.DEMOGRAPHICS_TIEBREAK)


def _event_keys(spark, d):
    """The star's key columns of the cleaned events with their row counts and
    arrivals, from one scan: as many rows as there are combinations."""
    events = _clean_arrivals(spark, d)
    return (events.groupBy("visatype", "i94res", sas_date("arrdate").alias("arrdate"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("arrivals"))
            .checkpoint(eager=True))


def _visa_keys(keys, visa):
    """``keys`` with the visa key in place of the visa type."""
    v = visa.select(F.col("visatype").alias("_vt"), "visa_type_key")
    return lookup_join(keys, v, keys["visatype"] == v["_vt"], "left").drop("_vt", "visatype")


def _visa(spark, d):
    return M.visa_type_dim(_clean_arrivals(spark, d))


def _fact(spark, d, events=None):
    events = events if events is not None else _clean_arrivals(spark, d)
    return arrivals_fact(events, M.visa_type_dim(events))


def _country(spark, d, events=None):
    events = events if events is not None else _clean_arrivals(spark, d)
    return M.country_dim(events, B.country_mapping(spark, d), _clean_temperatures(spark, d))


def _demographics_dim(spark, d):
    return M.demographics_dim(_clean_demographics(spark, d))


def _demographics_rows(spark, d):
    """The dimension's rows without ids: the state rollup never reads the id."""
    return C.rename_columns(_clean_demographics(spark, d), schemas.DEMOGRAPHICS_RENAMES)


# ---------------------------------------------------------------- sources / sinks

def src_arrivals(spark, d):
    """Events staged as ORC, loaded through the named data source."""
    path = scratch_path(spark, "arrivals_orc")
    arrivals = _arrivals(spark, d)
    arrivals.write.orc(path)
    return read_events(spark, path, "orc", arrivals.schema)


def src_csv_mapping(spark, d):
    """The country mapping as CSV with a header, read with its schema."""
    path = scratch_path(spark, "mapping_csv")
    B.country_mapping(spark, d).write.option("header", True).csv(path)
    return read_csv_table(spark, path, schemas.COUNTRY_MAPPING)


def src_csv_inferred(spark, d):
    """The country mapping as CSV, its types inferred from the file."""
    path = scratch_path(spark, "mapping_csv")
    B.country_mapping(spark, d).write.option("header", True).csv(path)
    return read_csv_table(spark, path, infer_schema=True)


def src_csv_semicolon(spark, d):
    """S3: demographics as ';'-separated CSV."""
    path = scratch_path(spark, "demographics_csv")
    demo = B.demographics(spark, d)
    demo.write.option("header", True).option("sep", ";").csv(path)
    return read_csv_table(spark, path, demo.schema, sep=";")


def src_csv_reordered(spark, d):
    """A CSV whose columns stand in another order than the schema's."""
    path = scratch_path(spark, "mapping_csv")
    B.country_mapping(spark, d).select("Name", "code").write.option("header", True).csv(path)
    return read_csv_table(spark, path, schemas.COUNTRY_MAPPING)


def src_events_extra_column(spark, d):
    """Events whose files have a column the data dictionary does not know."""
    path = scratch_path(spark, "arrivals_extra")
    extra = F.when(F.col("cicid") % 2 == 0, F.lit("even")).alias("extra")
    _arrivals(spark, d).select("*", extra).write.parquet(path)
    return C.clean_arrivals(read_arrivals(spark, path))


def sink_parquet_overwrite(spark, d):
    """A second overwrite replaces the first content entirely."""
    path = scratch_path(spark, "visatype")
    visa = _visa(spark, d)  # keyed once (checkpointed), so both writes agree
    write_table(visa.withColumn("visa_type_key", F.col("visa_type_key") + 1000), path)
    write_table(visa, path)
    return read_table(spark, path)


def sink_parquet_partitioned(spark, d):
    """K2: the calendar written Hive-partitioned by year, month, week and read back."""
    path = scratch_path(spark, "immigration_calendar")
    write_table(M.calendar_dim(_clean_arrivals(spark, d)), path,
                partition_by=schemas.CALENDAR_PARTITIONS,
                spread_partitions=True)
    return read_table(spark, path)


# ---------------------------------------------------------------- projections / filters

def prj_drop_columns(spark, d):
    return C.drop_columns(_arrivals(spark, d), schemas.SPARSE_ARRIVAL_COLUMNS)


def prj_rename(spark, d):
    return C.rename_columns(_arrivals(spark, d), schemas.FACT_RENAMES)


def prj_select(spark, d):
    return _arrivals(spark, d).select("cicid", "visatype", "arrdate")


def fn_cast_string(spark, d):
    t = B.temperatures(spark, d)
    return t.select(F.col("dt").cast("string").alias("dt"), "City",
                    F.col("l_orderkey").cast("string").alias("l_orderkey"), "l_linenumber",
                    F.col("AverageTemperature").cast("string").alias("average_temperature"))


def flt_dropna_all(spark, d):
    return C.drop_all_missing(_arrivals(spark, d).select("cicid", "i94res", "arrdate", "visatype"),
                              ["i94res", "arrdate", "visatype"])


def flt_dropna_key(spark, d):
    return C.drop_all_missing(_arrivals(spark, d), ["cicid"])


def flt_dropna_one(spark, d):
    return C.drop_any_missing(B.temperatures(spark, d), ["AverageTemperature"])


def flt_dropna_any(spark, d):
    return C.drop_any_missing(B.demographics(spark, d), schemas.DEMOGRAPHICS_MEASURES)


# ---------------------------------------------------------------- profiles

def profile_missing(spark, d):
    return P.missing_profile(_arrivals(spark, d))


def profile_missing_nonzero(spark, d):
    return P.missing_nonzero(P.missing_profile(B.demographics(spark, d)))


def profile_sparse_columns(spark, d):
    return P.sparse_columns(P.missing_profile(_arrivals(spark, d)), 90.0)


def profile_duplicates(spark, d):
    return P.duplicate_profile(_arrivals(spark, d), ["cicid"])


def preview_rows(spark, d):
    return P.preview(C.drop_all_missing(_arrivals(spark, d), ["cicid"]),
                     ["cicid", "arrdate", "visatype", "i94addr"], 5)


def schema_report(spark, d):
    return P.schema_report(_arrivals(spark, d))


# ---------------------------------------------------------------- aggregates

def agg_row_count(spark, d):
    parts = [P.row_count(B.arrivals(spark, d), "arrivals"),
             P.row_count(B.temperatures(spark, d), "temperatures"),
             P.row_count(B.demographics(spark, d), "demographics"),
             P.row_count(B.country_mapping(spark, d), "country_mapping")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def agg_distinct(spark, d):
    return B.temperatures(spark, d).select("Country", "City").distinct()


def agg_dedup_keys(spark, d):
    return C.deduplicate(B.temperatures(spark, d), schemas.TEMPERATURE_KEYS,
                         order_by=B.TEMPERATURE_TIEBREAK)


def agg_avg_by_country(spark, d):
    return M.avg_by_country(_clean_temperatures(spark, d))


# ---------------------------------------------------------------- cleaning

def clean_arrivals(spark, d):
    return _clean_arrivals(spark, d)


def clean_temperatures(spark, d):
    return _clean_temperatures(spark, d)


def clean_demographics(spark, d):
    return _clean_demographics(spark, d)


def clean_report(spark, d):
    return C.clean_report(B.arrivals(spark, d), B.temperatures(spark, d), B.demographics(spark, d))


# ---------------------------------------------------------------- scalar functions

def fn_sas_date(spark, d):
    return _arrivals(spark, d).select("cicid", "arrdate",
                                      sas_date("arrdate").alias("arrival_date"))


def fn_calendar_parts(spark, d):
    a = _arrivals(spark, d).select("cicid", sas_date("arrdate").alias("arrival_date"))
    return a.withColumns(calendar_columns("arrival_date"))


def fn_title_case(spark, d):
    m = B.country_mapping(spark, d)
    return m.select("code", "Name", title_case("Name").alias("country_name"))


def key_surrogate(spark, d):
    return assign_key(_arrivals(spark, d).select("cicid"), "cicid", "id")


# ---------------------------------------------------------------- joins

def join_left_visa_key(spark, d):
    events = _clean_arrivals(spark, d)
    visa = M.visa_type_dim(events)
    ev = events.select("cicid", "visatype")
    v = visa.select(F.col("visatype").alias("_vt"), "visa_type_key")
    return lookup_join(ev, v, ev["visatype"] == v["_vt"], "left", stage=True).drop("_vt")


def join_left_mapping(spark, d):
    codes = _arrivals(spark, d).select(F.col("i94res").alias("country_code")).distinct()
    m = B.country_mapping(spark, d).select(F.col("code").cast("double").alias("country_code"),
                                           F.col("Name").alias("country_name"))
    return lookup_join(codes, m, "country_code", "left").distinct()


def join_left_name(spark, d):
    names = M.mapping_names(B.country_mapping(spark, d))
    avgs = M.country_averages(_clean_temperatures(spark, d))
    return lookup_join(names, avgs, "country_name", "left", stage=True)


def join_left_anti_orphans(spark, d):
    ev = _arrivals(spark, d).select("cicid", "i94res")
    m = B.country_mapping(spark, d).select(F.col("code").cast("double").alias("code"))
    return orphans(ev, m, "i94res", "code")


def join_asof_reading(spark, d):
    """Each arrival with the last reading of its country of residence at or before
    its date (of several on one day, the last by city, spelling and row)."""
    names = M.mapping_names(B.country_mapping(spark, d))
    events = lookup_join(
        typed_arrivals(_clean_arrivals(spark, d)).select(
            "record_id", "arrdate", F.col("country_residence_code").alias("country_code")),
        names, "country_code", "left")
    readings = _clean_temperatures(spark, d).withColumn("_country", title_case("Country"))
    values = {"dt": "reading_date", "City": "reading_city", "AverageTemperature": "temperature"}
    readings = readings.withColumns({new: F.col(old) for old, new in values.items()})
    return asof_join(events, readings, [("country_name", "_country")], "arrdate", "dt",
                     list(values.values()), ["City", "Country", *B.TEMPERATURE_TIEBREAK])


# ---------------------------------------------------------------- the star

def dim_visa_type(spark, d):
    return _visa(spark, d)


def dim_calendar(spark, d):
    return M.calendar_dim(_clean_arrivals(spark, d))


def dim_country(spark, d):
    return _country(spark, d)


def dim_demographics(spark, d):
    return _demographics_dim(spark, d)


def fact_arrivals(spark, d):
    return _fact(spark, d)


def stream_ingest_arrivals(spark, d):
    """Streaming ingestion: arrivals landed in two drops, each cleaned and
    appended exactly once by a run of its own with the default checkpoint."""
    arrivals = _arrivals(spark, d)
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "arrivals_table")
    first = F.coalesce(F.col("i94mon") <= 6, F.lit(True))
    for drop in (arrivals.where(first), arrivals.where(~first)):
        drop.write.mode("append").parquet(landing)
        ingest_arrivals(spark, landing, table, arrivals.schema).awaitTermination()
    return read_table(spark, table)


def stream_dedup_late(spark, d):
    """Events that land in four drops, some late, some repeated: what became of each.
    Drops follow the days of the events; every 17th event lands one drop later, every
    10th lands in the next drop too, every 13th twice in its own."""
    events = B._read(spark, d, "events")
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "events_table")
    k = F.col("event_id")
    drop = F.least(F.lit(2), F.floor(F.datediff("ts", F.lit("2024-01-01")) / 8).cast("int"))
    own = drop + F.when(k % 17 == 0, 1).otherwise(0)
    lands = F.array_compact(F.array(own, F.when(k % 10 == 0, drop + 1), F.when(k % 13 == 0, own)))
    landed = events.withColumn("drop", F.explode(lands))
    for i in range(4):
        (landed.where(F.col("drop") == i).select(*events.columns)
         .write.mode("append").parquet(landing))
        ingest_events(spark, landing, table, events.schema, ["event_id"], "ts", "2 days")
    return outcomes(spark, table, ["event_id"], "ts")


def stream_weekly_upsert(spark, d):
    """Weekly arrivals per state, kept up to date over three drops of events."""
    arrivals = _arrivals(spark, d)
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "weekly_arrivals")
    year = F.coalesce(F.col("i94yr"), F.lit(0))
    for drop in (year < 1995, (year >= 1995) & (year < 1997), year >= 1997):
        C.clean_arrivals(arrivals.where(drop)).write.mode("append").parquet(landing)
        schema = C.clean_arrivals(arrivals).schema
        stream_weekly_arrivals(spark, landing, table, schema).awaitTermination()
    return read_table(spark, table).select("week", "state_code", "arrivals")


def join_interval_transit(spark, d):
    """Line items in transit (a day per unit after shipping) while an order of the same
    customer was open (30 days; every 500th for three years)."""
    # Both joins are of two tables that grow alike: sorted and merged at every size.
    orders = B._read(spark, d, "orders")
    ship = F.to_date("l_shipdate")
    lines = B._read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", ship.alias("shipped"),
        F.date_add(ship, F.col("l_quantity").cast("int")).alias("arrived"))
    owners = orders.select(F.col("o_orderkey").alias("_order"), F.col("o_custkey").alias("owner"))
    transit = lines.join(owners.hint("merge"), F.col("l_orderkey") == F.col("_order")).select(
        "l_orderkey", "l_linenumber", "owner", "shipped", "arrived")
    day = F.to_date("o_orderdate")
    held = F.when(F.col("o_orderkey") % 500 == 0, 1095).otherwise(30)
    open_ = orders.select("o_orderkey", "o_custkey", day.alias("opened"),
                          F.date_add(day, held).alias("closed"))
    met = interval_join(transit, open_.hint("merge"), [("owner", "o_custkey")],
                        ("shipped", "arrived"), ("opened", "closed"), left_lengths=lines)
    return met.select("l_orderkey", "l_linenumber", "o_orderkey", "o_custkey", "shipped", "arrived",
                      "opened", "closed")


def an_presence_by_day(spark, d):
    """People present per state and day, each from the arrival on for a number of days
    that follows from the record's id."""
    events = typed_arrivals(_clean_arrivals(spark, d))
    stays = events.select("state_code", "arrdate", F.date_add(
        "arrdate", F.coalesce(F.col("record_id").cast("int") % 45, F.lit(0))).alias("leaves"))
    return presence_by_day(stays, "state_code", "arrdate", "leaves")


def an_arrivals_rollup(spark, d):
    """Arrivals and countries of residence by state, visa type and month, with totals
    of the months, of the visa types, and of everything."""
    events = typed_arrivals(_clean_arrivals(spark, d)).select(
        "state_code", "visatype", F.trunc("arrdate", "month").alias("month"),
        "country_residence_code")
    sets = [["state_code", "visatype", "month"], ["state_code", "visatype"], ["state_code"], []]
    return distinct_rollup(events, sets, "country_residence_code", "n_countries", "n_events")


def dim_demographics_history(spark, d):
    """History of the demographics over two snapshots, the second one applied twice:
    it lacks some rows, brings others, and counts more foreign-born in some."""
    demo = _clean_demographics(spark, d).select(*schemas.DEMOGRAPHICS_KEYS, "Foreign-born",
                                                "Total Population", "c_custkey")
    rows, k = C.rename_columns(demo, {c: n for c, n in schemas.DEMOGRAPHICS_RENAMES.items()
                                      if c in demo.columns}), F.col("c_custkey")
    path = scratch_path(spark, "demographics_history")
    first = rows.where(k % 13 != 0).drop("c_custkey")
    second = rows.where(k % 11 != 0).withColumn("foreign_born", F.when(
        k % 7 == 0, F.col("foreign_born") + 1).otherwise(F.col("foreign_born"))).drop("c_custkey")
    keys = ["City", "State", "state_code", "Race"]
    for day, snapshot in (("2016-04-01", first), ("2016-05-01", second), ("2016-05-01", second)):
        history = update_history(spark, path, snapshot, keys, day)
    return history


def qc_reconcile_loads(spark, d):
    """Two loads of the cleaned events compared as multisets: the second one lacks
    every 97th record, holds every 89th twice and counts another number in every 83rd."""
    first = _clean_arrivals(spark, d)
    k = F.coalesce(F.col("cicid").cast("long"), F.lit(1))
    times = F.when(k % 97 == 0, 0).when(k % 89 == 0, 2).otherwise(1)
    second = (first.withColumn("_copy", F.explode(F.sequence(F.lit(0), times))).where("_copy > 0")
              .drop("_copy").withColumn("count", F.when(k % 83 == 0, 2.0).otherwise(F.col("count"))))
    return reconcile(first, second)


def src_nested_payloads(spark, d):
    """Events with their JSON payloads parsed, one row per tag; rejects with a reason.
    Every 19th text is cut off, every 23rd missing, every 29th without its field."""
    events, k = B._read(spark, d, "events"), F.col("event_id")
    tags = F.array_join(F.transform(F.sequence(F.lit(0), k % 3), lambda i: F.concat(
        F.lit('"t'), i.cast("string"), F.lit('"'))), ",")
    full = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "tags": ['),
                    F.when(k % 4 == 0, F.lit("")).otherwise(tags), F.lit("]}"))
    text = (F.when(k % 19 == 0, F.expr("substring(props, 1, length(props) - 1)"))
            .when(k % 29 == 0, F.lit('{"tags": ["t"]}')).when(k % 23 != 0, full))
    parsed = parse_payloads(events.select("event_id", text.alias("body")), "body", T.StructType([
        T.StructField("k", T.LongType()), T.StructField("tags", T.ArrayType(T.StringType()))]), ["k"])
    rows = exploded(parsed, "payload.tags", "tag")
    return rows.select("event_id", "reason", F.col("payload.k").alias("k"),
                       F.col("item_no").alias("tag_no"), "tag")


def agg_merged_states(spark, d):
    """Users per week from daily states that were written and merged, beside the exact
    number, and whether they agree within four standard errors."""
    events, path = B._read(spark, d, "events"), scratch_path(spark, "states")
    save_states(daily_states(events, "ts", "user_id"), path)
    merged = merged_counts(spark, path, "week")
    week = F.to_date(F.date_trunc("week", F.col("ts").cast("timestamp")))
    exact = events.groupBy(week.alias("_start")).agg(F.count_distinct("user_id").alias("n_exact"))
    off = F.abs(F.col("n_members") - F.col("n_exact"))
    return (merged.join(exact, F.col("period_start") == F.col("_start"))
            .select("period_start", "n_rows", "n_exact",
                    (off <= 4 * standard_error() * F.col("n_exact")).alias("within_bound")))


def star_incremental(spark, d):
    """The star from two daily loads, the second one run again: the fact with the
    ids and members of its dimensions."""
    arrivals, output = _arrivals(spark, d), scratch_path(spark, "star")
    temperatures, mapping = B.temperatures(spark, d), B.country_mapping(spark, d)
    first = F.coalesce(F.col("i94mon") <= 6, F.lit(True))
    for day, load in (("2016-04-01", first), ("2016-04-02", ~first), ("2016-04-02", ~first)):
        star = update_star(spark, output, day, arrivals.where(load), temperatures, mapping,
                           temperature_order=B.TEMPERATURE_TIEBREAK)
    days = star["immigration_calendar"].select(
        F.col("arrdate").alias("_day"), F.col("id").alias("calendar_id"), "arrival_week")
    fact = star["immigration_fact"]
    return (fact.join(star["visatype"], "visa_type_key", "left")
            .join(days, fact["arrdate"].eqNullSafe(F.col("_day")), "left")
            .join(star["country"], F.col("country_residence_code") == F.col("country_code"), "left")
            .select("load_day", "record_id", "state_code", "count", "arrdate", "visa_type_key",
                    "visatype", "calendar_id", "arrival_week", "country_name",
                    "average_temperature"))


def star_from_files(spark, d):
    """M6-M8 end to end from files, as the original job ran: the four inputs are
    landed in their source formats, read back and turned into the star.  Returns
    the rows of the written tables: the fact joined with its dimensions, then
    the demographics."""
    inputs = {"arrivals": B.arrivals(spark, d), "temperatures": B.temperatures(spark, d),
              "demographics": B.demographics(spark, d), "mapping": B.country_mapping(spark, d)}
    paths = {k: scratch_path(spark, k) for k in inputs}
    inputs["arrivals"].write.parquet(paths["arrivals"])
    for k, sep in (("temperatures", ","), ("demographics", ";"), ("mapping", ",")):
        inputs[k].write.option("header", True).option("sep", sep).csv(paths[k])
    config = PipelineConfig(
        events=paths["arrivals"], output=scratch_path(spark, "star"),
        temperatures=paths["temperatures"], demographics=paths["demographics"],
        country_mapping=paths["mapping"], events_schema=inputs["arrivals"].schema,
        temperatures_schema=inputs["temperatures"].schema,
        demographics_schema=inputs["demographics"].schema)
    star = run_pipeline(spark, config, temperature_order=B.TEMPERATURE_TIEBREAK,
                        demographics_order=B.DEMOGRAPHICS_TIEBREAK, checks=False)
    fact, days = star["immigration_fact"], star["immigration_calendar"]
    days = days.select(F.col("arrdate").alias("_day"), F.col("id").alias("calendar_id"),
                       "arrival_week")
    rows = (fact.join(star["visatype"], "visa_type_key", "left")
            .join(F.broadcast(days), fact["arrdate"].eqNullSafe(days["_day"]), "left")
            .join(star["country"], fact["country_residence_code"] == F.col("country_code"), "left"))
    part = rows.select(F.lit("fact").alias("part"), "record_id", "state_code", "count", "arrdate",
                       "calendar_id", "arrival_week", "visatype", "country_name",
                       "average_temperature")
    people = star["demographics"].select(
        F.lit("demographics").alias("part"), "state_code",
        F.col("Count").cast("double").alias("count"),
        F.col("average_household_size").alias("average_temperature"), F.col("City").alias("city"),
        F.col("Race").alias("race"), F.col("id").alias("demographics_id"))
    return part.unionByName(people, allowMissingColumns=True)


def sql_star_view(spark, d):
    """Ad-hoc SQL with aliases and a qualified star over registered views:
    the dimensions and the events counted by their keys, from one scan of them.

    The views exist while the statement is analysed; its result does not need
    them.
    """
    keys = _event_keys(spark, d)
    visa = M.visa_type_dim(keys)
    counts = (_visa_keys(keys, visa).groupBy("visa_type_key", "i94res")
              .agg(F.sum("n").alias("n"), F.sum("arrivals").alias("arrivals")))
    tables = {"arrival_counts": counts, "visatype": visa, "country": _country(spark, d, keys)}
    v = register_star(tables, f"star_{uuid.uuid4().hex[:12]}_")
    out = spark.sql(f"""
        SELECT c.*, t.visatype, sum(f.n) AS n_events, sum(f.arrivals) AS arrivals
        FROM {v['arrival_counts']} f
        LEFT JOIN {v['visatype']} t ON f.visa_type_key = t.visa_type_key
        LEFT JOIN {v['country']} c ON f.i94res = c.country_code
        GROUP BY c.country_code, c.country_name, c.average_temperature, t.visatype""")
    for view in v.values():
        spark.catalog.dropTempView(view)
    return out


# ---------------------------------------------------------------- quality / analytics

def qc_row_counts(spark, d):
    """Q1 from one scan of the events: rows of the fact are the cleaned events,
    rows of a dimension its distinct members, so no id or join is needed."""
    keys = _event_keys(spark, d)
    codes = M.named_countries(keys.select(F.col("i94res").alias("country_code")),
                              B.country_mapping(spark, d))
    n = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    fact = n.select(F.lit("immigration_fact").alias("table_name"), "n_rows",
                    (F.col("n_rows") > 0).alias("passed"))
    return fact.unionByName(row_count_checks({
        "visatype": keys.select("visatype").distinct(),
        "immigration_calendar": keys.select("arrdate").distinct(),
        "country": codes,
        "demographics": _clean_demographics(spark, d),
    }))


def qc_referential(spark, d):
    """Q2 from one scan of the events: their key columns, counted, stand for the fact."""
    keys = _event_keys(spark, d)
    visa = M.visa_type_dim(keys)
    days = M.calendar_of(keys.select("arrdate"))
    return referential_checks(_visa_keys(keys, visa), {
        "fact_country": ("i94res", _country(spark, d, keys), "country_code"),
        "fact_visatype": ("visa_type_key", visa, "visa_type_key"),
        "fact_calendar": ("arrdate", days, "arrdate"),
    }, weight="n")


def an_arrivals_by_climate(spark, d):
    return A.climate_of_events(_clean_arrivals(spark, d), B.country_mapping(spark, d),
                               _clean_temperatures(spark, d))


def an_arrivals_by_state(spark, d):
    return A.arrivals_by_state(typed_arrivals(_clean_arrivals(spark, d)),
                               _demographics_rows(spark, d), monthly=True)


def an_arrivals_by_state_year(spark, d):
    return A.arrivals_by_state(typed_arrivals(_clean_arrivals(spark, d)),
                               _demographics_rows(spark, d), monthly=False)


QUERIES: dict[str, Query] = {name: fn for name, fn in [
    ("src_arrivals", src_arrivals), ("src_csv_mapping", src_csv_mapping),
    ("src_csv_semicolon", src_csv_semicolon), ("src_csv_reordered", src_csv_reordered),
    ("src_events_extra_column", src_events_extra_column),
    ("sink_parquet_overwrite", sink_parquet_overwrite),
    ("sink_parquet_partitioned", sink_parquet_partitioned),
    ("prj_drop_columns", prj_drop_columns), ("prj_rename", prj_rename),
    ("prj_select", prj_select), ("fn_cast_string", fn_cast_string),
    ("flt_dropna_all", flt_dropna_all), ("flt_dropna_key", flt_dropna_key),
    ("flt_dropna_one", flt_dropna_one), ("flt_dropna_any", flt_dropna_any),
    ("profile_missing", profile_missing), ("profile_missing_nonzero", profile_missing_nonzero),
    ("profile_sparse_columns", profile_sparse_columns),
    ("profile_duplicates", profile_duplicates),
    ("agg_row_count", agg_row_count), ("agg_distinct", agg_distinct),
    ("agg_dedup_keys", agg_dedup_keys), ("agg_avg_by_country", agg_avg_by_country),
    ("clean_arrivals", clean_arrivals), ("clean_temperatures", clean_temperatures),
    ("clean_demographics", clean_demographics), ("clean_report", clean_report),
    ("fn_sas_date", fn_sas_date), ("fn_calendar_parts", fn_calendar_parts),
    ("fn_title_case", fn_title_case), ("key_surrogate", key_surrogate),
    ("join_left_visa_key", join_left_visa_key), ("join_left_mapping", join_left_mapping),
    ("join_left_name", join_left_name), ("join_left_anti_orphans", join_left_anti_orphans),
    ("dim_visa_type", dim_visa_type), ("dim_calendar", dim_calendar),
    ("dim_country", dim_country), ("dim_demographics", dim_demographics),
    ("fact_arrivals", fact_arrivals), ("stream_ingest_arrivals", stream_ingest_arrivals),
    ("star_from_files", star_from_files),
    ("sql_star_view", sql_star_view), ("preview_rows", preview_rows),
    ("schema_report", schema_report), ("qc_row_counts", qc_row_counts),
    ("qc_referential", qc_referential), ("an_arrivals_by_climate", an_arrivals_by_climate),
    ("an_arrivals_by_state", an_arrivals_by_state),
    ("an_arrivals_by_state_year", an_arrivals_by_state_year),
    ("join_asof_reading", join_asof_reading), ("star_incremental", star_incremental),
    ("src_csv_inferred", src_csv_inferred), ("join_interval_transit", join_interval_transit),
    ("an_presence_by_day", an_presence_by_day), ("an_arrivals_rollup", an_arrivals_rollup),
    ("dim_demographics_history", dim_demographics_history),
    ("qc_reconcile_loads", qc_reconcile_loads), ("src_nested_payloads", src_nested_payloads),
    ("agg_merged_states", agg_merged_states),
    ("stream_dedup_late", stream_dedup_late), ("stream_weekly_upsert", stream_weekly_upsert),
]}
