import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.config import scratch_path
from starmart.operators.joins import orphans
from starmart.plans import analytics as A
from starmart.plans import dims as M
from starmart.plans.fact import arrivals_fact
from starmart.plans.pipeline import STAR_TABLES, build_star
from starmart.plans.quality import assert_quality, referential_checks, row_count_checks
from starmart.sources import bindings as B

EV = ("cicid double, i94res double, arrdate double, visatype string, i94addr string, "
      "count double")


def _events(spark, rows):
    return spark.createDataFrame(rows, EV)


def test_null_visa_type_keeps_null_key(spark):
    ev = _events(spark, [(1.0, 1.0, 20545.0, "B1", "NY", 1.0), (2.0, 1.0, 20545.0, None, "NY", 1.0)])
    visa = M.visa_type_dim(ev)
    assert {r.visatype for r in visa.collect()} == {"B1", None}
    fact = {r.record_id: r.visa_type_key for r in arrivals_fact(ev, visa).collect()}
    assert fact[1.0] is not None and fact[2.0] is None


def test_fact_columns_and_date(spark):
    ev = _events(spark, [(1.0, 1.0, 20545.0, "B1", "NY", 1.0)])
    fact = arrivals_fact(ev, M.visa_type_dim(ev))
    assert fact.columns == ["record_id", "country_residence_code", "arrdate", "state_code",
                            "count", "visa_type_key"]
    assert fact.first().arrdate == dt.date(2016, 4, 1)


def test_mapping_join_unmapped_and_null(spark):
    ev = _events(spark, [(1.0, 582.0, 1.0, "B1", "NY", 1.0), (2.0, 12345.0, 1.0, "B1", "NY", 1.0),
                         (3.0, None, 1.0, "B1", "NY", 1.0), (4.0, 582.0, 1.0, "B1", "NY", 1.0)])
    mapping = spark.createDataFrame([(582, "RIO-GRANDE (NORTH, 2)"), (0, "NO COUNTRY: NONE"),
                                     (705, "NO COUNTRY: NONE")], "code int, Name string")
    temps = spark.createDataFrame([("Rio-Grande (North, 2)", 20.0), ("RIO-GRANDE (north, 2)", 22.0)],
                                  "Country string, AverageTemperature double")
    dim = {r.country_code: (r.country_name, r.average_temperature)
           for r in M.country_dim(ev, mapping, temps).collect()}
    assert dim == {582.0: ("Rio-Grande (North, 2)", 21.0), 12345.0: (None, None), None: (None, None)}


def test_calendar_null_date_row(spark):
    ev = _events(spark, [(1.0, 1.0, None, "B1", "NY", 1.0), (2.0, 1.0, 20454.0, "B1", "NY", 1.0)])
    cal = {r.arrdate: r for r in M.calendar_dim(ev).collect()}
    assert set(cal) == {None, dt.date(2016, 1, 1)}
    assert cal[None].id == 0 and cal[None].arrival_year is None
    assert cal[dt.date(2016, 1, 1)].arrival_week == 53


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert sorted((r.k or -1) for r in orphans(fact, dim, "k", "k").collect()) == [-1, 9]
    res = referential_checks(fact, {"c": ("k", dim, "k")}).first()
    assert (res.orphans, res.null_keys, res.passed) == (1, 1, False)
    with pytest.raises(AssertionError, match="1 quality checks failed"):
        assert_quality(referential_checks(fact, {"c": ("k", dim, "k")}))
    # Rows without a key are sound, and so is an empty fact.
    sound = fact.where("k is null or k = 1")
    assert_quality(referential_checks(sound, {"c": ("k", dim, "k")}))
    empty = referential_checks(fact.limit(0), {"c": ("k", dim, "k"), "d": ("k", dim, "k")})
    assert sorted(map(tuple, empty.collect())) == [("c", 0, 0, True), ("d", 0, 0, True)]


def test_orphans_count_keys_before_they_meet_the_dimension(spark):
    """A key of a third of all rows is one row in the shuffle."""
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    dim = spark.range(10, 5000).select(F.col("id").alias("k"))
    assert orphans(fact, dim, "k", "k").groupBy("k").count().where("k = 7").first()["count"] == 1001
    plan = referential_checks(fact, {"c": ("k", dim, "k")})._jdf.queryExecution().toString()
    assert "partial_count" in plan and "Limit" not in plan


def test_row_count_checks(spark):
    res = row_count_checks({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: (r.n_rows, r.passed) for r in res.collect()} == {
        "a": (3, True), "b": (0, False)}


def test_state_rollup_counts_city_once(spark):
    demo = spark.createDataFrame(
        [("C", "S", "ST", f"R{i}", 100000) for i in range(3)],
        "City string, State string, state_code string, Race string, total_population int")
    assert A.state_population(demo).first().population == 100000


def test_climate_bands(spark):
    fact = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (2.0, 1.0), (None, 1.0), (3.0, 1.0)],
                                 "country_residence_code double, count double")
    dim = spark.createDataFrame([(1.0, "A", 20.0), (2.0, "B", 5.0), (3.0, None, None)],
                                "country_code double, country_name string, average_temperature double")
    got = {r.climate: (r.arrivals, r.countries) for r in A.arrivals_by_climate(fact, dim).collect()}
    assert got == {"warm": (1.0, 1), "cold": (2.0, 1), "unknown": (2.0, 1)}


def test_pipeline_writes_star(spark):
    d = "/root/testdata/sf0.001"
    out = scratch_path(spark, "star")
    tables = build_star(spark, B.arrivals(spark, d), B.temperatures(spark, d),
                        B.demographics(spark, d), B.country_mapping(spark, d), out,
                        temperature_order=B.TEMPERATURE_TIEBREAK,
                        demographics_order=B.DEMOGRAPHICS_TIEBREAK)
    assert set(tables) == set(STAR_TABLES)
    assert tables["immigration_fact"].count() == 1492 < B.arrivals(spark, d).count()
    country = tables["country"]
    assert country.count() == country.select("country_code").distinct().count()
    cal = tables["immigration_calendar"]
    assert set(cal.columns) >= {"arrival_year", "arrival_month", "arrival_week", "id"}
    ids = sorted(r.id for r in cal.collect())
    assert ids == list(range(len(ids)))


def test_pipeline_refuses_output_equal_to_input(spark):
    d = "/root/testdata/sf0.001"
    with pytest.raises(ValueError):
        build_star(spark, B.arrivals(spark, d), B.temperatures(spark, d),
                   B.demographics(spark, d), B.country_mapping(spark, d), "/tmp/x/",
                   inputs=["/tmp/x"])


def test_country_name_aliases(spark):
    ev = _events(spark, [(1.0, 245.0, 1.0, "B1", "NY", 1.0)])
    mapping = spark.createDataFrame([(245, "NORLAND, UPPER")], "code int, Name string")
    temps = spark.createDataFrame([("Norland", 10.0)], "Country string, AverageTemperature double")
    plain = M.country_dim(ev, mapping, temps).first()
    assert (plain.country_name, plain.average_temperature) == ("Norland, Upper", None)
    aliased = M.country_dim(ev, mapping, temps, aliases={"Norland, Upper": "Norland"}).first()
    assert (aliased.country_name, aliased.average_temperature) == ("Norland", 10.0)
