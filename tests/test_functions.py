import datetime as dt
import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import calendar_columns, is_missing, sas_date, title_case


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_sas_date_valid_days(spark):
    df = _one_col(spark, [20545.0, 20574.0, 20545.7, 1.0, -1.0, -0.5], T.DoubleType())
    got = [r[0] for r in df.select(sas_date("x")).collect()]
    assert got == [dt.date(2016, 4, 1), dt.date(2016, 4, 30), dt.date(2016, 4, 1),
                   dt.date(1960, 1, 2), dt.date(1959, 12, 31), dt.date(1959, 12, 31)]


def test_sas_date_no_value(spark):
    df = _one_col(spark, [0.0, None, float("nan"), 1e7, -1e7], T.DoubleType())
    assert [r[0] for r in df.select(sas_date("x")).collect()] == [None] * 5


def test_sas_date_zero_kept_when_asked(spark):
    df = _one_col(spark, [0.0], T.DoubleType())
    assert df.select(sas_date("x", zero_is_null=False)).first()[0] == dt.date(1960, 1, 1)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=-700000, max_value=2900000, allow_nan=False), min_size=1,
                max_size=20))
def test_sas_date_equals_python_formula(spark, days):
    df = _one_col(spark, days, T.DoubleType())
    got = [r[0] for r in df.select(sas_date("x")).collect()]
    want = [(dt.date(1960, 1, 1) + dt.timedelta(x)) if x else None for x in days]
    assert got == want


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),), (None,)], "d date")
    rows = df.select(*[c.alias(n) for n, c in calendar_columns("d").items()]).collect()
    assert rows[0].asDict() == dict(arrival_weekday=6, arrival_day=1, arrival_week=53,
                                    arrival_month=1, arrival_year=2016)
    assert all(v is None for v in rows[1])


def test_title_case_cases(spark):
    names = ["RIO-GRANDE", "NORDEN, NEW", "WEST ISLES (PART OF NORDEN)", "NATION_0",
             "NO COUNTRY: NONE", None, ""]
    df = _one_col(spark, names, T.StringType())
    got = [r[0] for r in df.select(title_case("x")).collect()]
    assert got == ["Rio-Grande", "Norden, New", "West Isles (Part Of Norden)",
                   "Nation_0", "No Country: None", None, ""]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=string.ascii_letters + string.digits + " -_,.()':/",
                        max_size=30), min_size=1, max_size=30))
def test_title_case_equals_str_title(spark, names):
    df = _one_col(spark, names, T.StringType())
    got = [r[0] for r in df.select(title_case("x")).collect()]
    assert got == [n.title() for n in names]


def test_is_missing_by_type(spark):
    d = _one_col(spark, [1.0, float("nan"), None], T.DoubleType())
    assert d.where(is_missing("x", T.DoubleType())).count() == 2
    s = _one_col(spark, ["abc", "NaN", None], T.StringType())
    assert s.where(is_missing("x", T.StringType())).count() == 2
    dd = _one_col(spark, [dt.date(2020, 1, 1), None], T.DateType())
    assert dd.where(is_missing("x", T.DateType())).count() == 1


def test_no_python_udf_in_expressions(spark):
    df = _one_col(spark, [20545.0], T.DoubleType())
    plan = df.select(sas_date("x"), title_case(F.lit("A B"))).  \
        _jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
