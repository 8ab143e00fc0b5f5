"""Numbers recorded in FIXTURES.md for sf0.01 (measured independently with DuckDB)."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_climate_bands(spark):
    got = {r.climate: (r.arrivals, r.countries) for r in q(spark, "an_arrivals_by_climate").collect()}
    assert got["warm"] == (5624.0, 10) and got["cold"] == (8908.0, 15)
    assert got["unknown"] == (396.0, 2)


def test_country_dimension_and_temperatures(spark):
    c = q(spark, "dim_country").selectExpr("count(*) AS n", "count(average_temperature) AS a").first()
    assert (c.n, c.a) == (28, 25)
    t = q(spark, "clean_temperatures").selectExpr("count(*) AS n", "sum(AverageTemperature) AS s")
    assert tuple(t.first()) == (47698, 735575.0)


def test_state_month_rollup(spark):
    st = q(spark, "an_arrivals_by_state")
    # 397 dated (state, year, month) rows; arrivals without a date are kept as their own rows.
    assert st.where("arrival_year IS NOT NULL").count() == 397
    assert st.agg({"arrivals": "sum"}).first()[0] == 14928.0


def test_cleaning_counts(spark):
    """Every cleaning step changes rows."""
    rep = {(r.table_name, r.step): (r.rows_in, r.rows_out) for r in q(spark, "clean_report").collect()}
    assert rep[("arrivals", "dropna_all")] == (15000, 14928)
    assert rep[("temperatures", "dropna_temperature")] == (60000, 50429)
    assert rep[("temperatures", "dedup")] == (50429, 47698)
    assert rep[("demographics", "dropna_measures")] == (1500, 1198)
    assert rep[("demographics", "dedup")] == (1198, 529)


def test_profiles_see_what_they_look_for(spark):
    d = q(spark, "profile_duplicates").first()
    assert (d.n_rows, d.n_distinct) == (15000, 14662)
    miss = {r.cols: r["values"] for r in q(spark, "profile_missing").collect()}
    assert miss["cicid"] == 209 and miss["visatype"] == 334 and miss["i94res"] == 323
    assert 0.90 < miss["entdepu"] / 15000 < 0.92
    assert {r.cols for r in q(spark, "profile_missing_nonzero").collect()} == {
        "Male Population", "Female Population", "Number of Veterans", "Foreign-born",
        "Average Household Size"}
    for name in ("flt_dropna_all", "flt_dropna_key", "clean_arrivals"):
        assert q(spark, name).count() < 15000
