"""Every registered query equals its DuckDB twin (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as E
from starmart.plans.catalog import QUERIES
from tests.oracle_harness import compare, duck, type_mismatches

SF = "/root/testdata/sf0.001"
_con = None


def con():
    global _con
    if _con is None:
        _con = duck(SF)
    return _con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, con(), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["cols"], (r["spark_cols"], r["duck_cols"])
    assert r["n"][0] == r["n"][1]
    assert r["values"], (r["s_only"], r["d_only"])
    assert not type_mismatches(r["schema"], r["duck_types"])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"climate", "arrivals", "countries"}
    assert df.count() >= 0
