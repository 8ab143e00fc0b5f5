"""The driver contract of __spark_entry__, and the C5 -> C1 link."""

import inspect

import __spark_entry__ as E
from starmart.operators import clean as C
from starmart.operators.profile import sparse_column_names
from starmart.sources import bindings as B


def test_queries_take_spark_and_dir():
    qs = E.queries()
    assert len(qs) >= 48 and set(E.oracle_sql()) <= set(qs)
    for fn in qs.values():
        assert len(inspect.signature(fn).parameters) == 2


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and a.count() == b.count() == 3


def test_auto_sparse_columns(spark):
    ev = B.arrivals(spark, "/root/testdata/sf0.001")
    assert sorted(sparse_column_names(ev)) == ["entdepu", "insnum", "occup"]
    auto = C.clean_arrivals(ev, sparse_columns="auto")
    assert auto.columns == C.clean_arrivals(ev).columns
