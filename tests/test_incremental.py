"""Daily update of the star: two loads equal one build, reruns change nothing."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from starmart.config import scratch_path
from starmart.operators.keys import extend_key
from starmart.plans.incremental import read_star, update_star
from starmart.plans.pipeline import build_event_tables
from starmart.sources import bindings as B

SF = "/root/testdata/sf0.001"


def loads(spark):
    arrivals = B.arrivals(spark, SF)
    first = F.coalesce(F.col("i94mon") <= 6, F.lit(True))
    return arrivals, arrivals.where(first), arrivals.where(~first)


def load(spark, out, day, arrivals):
    return update_star(spark, out, day, arrivals, B.temperatures(spark, SF),
                       B.country_mapping(spark, SF), temperature_order=B.TEMPERATURE_TIEBREAK)


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def content(star):
    return {name: rows(df) for name, df in star.items()}


def files(out, *but):
    return sorted(f for f in glob.glob(f"{out}/**/*.parquet", recursive=True)
                  if not any(f"/{b}/" in f for b in but))


@pytest.fixture(scope="module")
def two_days(spark):
    out = scratch_path(spark, "incremental").removeprefix("file:")
    arrivals, one, two = loads(spark)
    first = content(load(spark, out, "2016-04-01", one))
    return out, arrivals, one, two, first, load(spark, out, "2016-04-02", two)


def flat(star):
    """The fact with the members instead of the ids of its dimensions."""
    return (star["immigration_fact"].join(star["visatype"], "visa_type_key", "left")
            .drop("visa_type_key", "load_day"))


def test_two_days_equal_one_build(spark, two_days):
    out, arrivals, _, _, _, star = two_days
    whole = build_event_tables(spark, arrivals, B.temperatures(spark, SF),
                               B.country_mapping(spark, SF), scratch_path(spark, "whole"),
                               temperature_order=B.TEMPERATURE_TIEBREAK)
    columns = flat(whole).columns
    assert rows(flat(star).select(*columns)) == rows(flat(whole))
    for name, key in (("visatype", "visa_type_key"), ("immigration_calendar", "id")):
        assert rows(star[name].select(*whole[name].columns), key) == rows(whole[name], key)
        ids = sorted(r[key] for r in star[name].collect())
        assert ids == list(range(len(ids)))
    assert rows(star["country"]) == rows(whole["country"])


def test_old_ids_stay(spark, two_days):
    _, _, _, _, first, star = two_days
    for name in ("visatype", "immigration_calendar"):
        assert set(first[name]) <= set(rows(star[name]))


def test_reruns_change_nothing(spark, two_days):
    out, _, one, two, _, star = two_days
    before = content(star)
    # A rerun of either day; key maps do not even get a file.
    for day, part in (("2016-04-02", two), ("2016-04-01", one)):
        held = files(out, "immigration_fact", "country")
        assert content(load(spark, out, day, part)) == before
        assert files(out, "immigration_fact", "country") == held
    assert content(read_star(spark, out)) == before


def test_a_load_replaces_its_own_events_only(spark, two_days):
    out, _, _, two, _, _ = two_days
    fewer = two.where(F.col("cicid") % 2 == 0)
    untouched = files(os.path.join(out, "immigration_fact", "load_day=2016-04-01"))
    star = load(spark, out, "2016-04-02", fewer)
    assert star["immigration_fact"].where("load_day = '2016-04-02'").count() == fewer.count()
    assert files(os.path.join(out, "immigration_fact", "load_day=2016-04-01")) == untouched
    # A member that no event names any more keeps its id.
    assert load(spark, out, "2016-04-02", two)["visatype"].count() == star["visatype"].count()


def test_extend_key(spark):
    known = spark.createDataFrame([("b", 0), (None, 1)], "k string, id long")
    members = spark.createDataFrame([(None,), ("a",), ("b",), ("c",)], "k string")
    got = extend_key(known, members, "k")
    assert sorted((r.k, r.id) for r in got.collect()) == [("a", 2), ("c", 3)]
    assert extend_key(known, known.select("k"), "k").count() == 0
    assert [r.id for r in extend_key(None, members, "k").orderBy("id").collect()] == [0, 1, 2, 3]
    assert extend_key(known.limit(0), members.limit(1), "k").first().id == 0
    assert extend_key(known, members, "k", None).columns == ["k"]
