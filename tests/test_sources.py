"""Readers and writers: any event format, CSV with quotes and ';', overwrite,
partitioned layout and partition pruning, and the whole pipeline from files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.config import scratch_path
from starmart.operators.clean import clean_arrivals, clean_demographics, clean_temperatures
from starmart.plans.pipeline import build_star, run_pipeline
from starmart.sources import PipelineConfig, read_csv_table, read_events, read_table, write_table
from starmart.sources import bindings as B

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_events_in_any_format(spark, fmt):
    ev = B.arrivals(spark, SF)
    path = scratch_path(spark, f"ev_{fmt}")
    w = ev.write.format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    opts = {"header": True} if fmt == "csv" else {}
    back = read_events(spark, path, fmt, ev.schema, **opts)
    assert back.dtypes == ev.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, ev.collect()))


def test_csv_quoted_commas_and_inference(spark):
    path = scratch_path(spark, "mapping")
    spark.createDataFrame([(31, "WEST ISLES Sea, Land (form B-2, all ports)"), (7, "NORDEN")],
                          "code int, Name string") \
        .coalesce(1).write.option("header", True).csv(path)
    explicit = read_csv_table(spark, path, schemas.COUNTRY_MAPPING)
    inferred = read_csv_table(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["code"] == "int"
    assert sorted(explicit.collect()) == sorted(inferred.collect())
    assert {r.Name for r in explicit.collect()} >= {"WEST ISLES Sea, Land (form B-2, all ports)"}


def test_csv_columns_are_bound_by_name(spark):
    path = scratch_path(spark, "mapping")
    rows = spark.createDataFrame([(31, "NORDEN", "x")], "code int, Name string, more string")
    rows.select("more", "Name", "code").write.option("header", True).csv(path)
    got = read_csv_table(spark, path, schemas.COUNTRY_MAPPING)
    assert got.dtypes == [("code", "int"), ("Name", "string"), ("more", "string")]
    assert tuple(got.first()) == (31, "NORDEN", "x")


def test_csv_with_a_wrong_header_raises(spark):
    path = scratch_path(spark, "mapping")
    spark.createDataFrame([(31, "NORDEN")], "kode int, Name string") \
        .write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="code"):
        read_csv_table(spark, path, schemas.COUNTRY_MAPPING)
    bad = scratch_path(spark, "mapping")
    spark.createDataFrame([("x1", "NORDEN")], "code string, Name string") \
        .write.option("header", True).csv(bad)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv_table(spark, bad, schemas.COUNTRY_MAPPING).collect()


def test_events_keep_their_columns_and_lack_none(spark):
    from starmart.plans.pipeline import read_arrivals
    ev = B.arrivals(spark, SF).withColumn("newcol", F.lit("n"))
    for fmt, options in (("parquet", {}), ("orc", {}), ("csv", {"sep": "|"})):
        path = scratch_path(spark, f"ev_{fmt}")
        ev.write.format(fmt).options(header=True, **options).save(path)
        back = read_arrivals(spark, path, fmt, **options)
        assert dict(back.dtypes) == dict(ev.dtypes)
        assert back.count() == ev.count() and back.where("newcol = 'n'").count() == ev.count()
    path = scratch_path(spark, "ev")
    ev.drop("arrdate").write.parquet(path)
    with pytest.raises(ValueError, match="arrdate"):
        read_arrivals(spark, path)


def test_semicolon_csv(spark):
    path = scratch_path(spark, "demo")
    demo = B.demographics(spark, SF)
    demo.write.option("header", True).option("sep", ";").csv(path)
    back = read_csv_table(spark, path, demo.schema, sep=";")
    assert back.count() == demo.count() and "Median Age" in back.columns


def test_overwrite_replaces_content(spark):
    path = scratch_path(spark, "t")
    write_table(spark.range(10), path)
    write_table(spark.range(3), path)
    assert read_table(spark, path).count() == 3


def test_partitioned_layout_and_pruning(spark):
    path = scratch_path(spark, "cal")
    df = spark.createDataFrame([(dt.date(2016, 1, 1), 2016, 1, 53), (None, None, None, None)],
                               "arrdate date, arrival_year int, arrival_month int, "
                               "arrival_week int")
    write_table(df, path, partition_by=schemas.CALENDAR_PARTITIONS, spread_partitions=True)
    back = read_table(spark, path)
    assert dict(back.dtypes)["arrival_year"] == "int"
    assert back.where(F.col("arrival_year").isNull()).count() == 1
    pruned = back.where(F.col("arrival_year") == 2016)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(arrival_year" in plan
    assert pruned.first().arrival_week == 53


def test_run_pipeline_from_files(spark):
    ins = {"arrivals": B.arrivals(spark, SF), "temperatures": B.temperatures(spark, SF),
           "demographics": B.demographics(spark, SF), "mapping": B.country_mapping(spark, SF)}
    paths = {k: scratch_path(spark, k) for k in ins}
    ins["arrivals"].write.json(paths["arrivals"])
    for k, sep in (("temperatures", ","), ("demographics", ";"), ("mapping", ",")):
        ins[k].write.option("header", True).option("sep", sep).csv(paths[k])
    cfg = PipelineConfig(events=paths["arrivals"], events_format="json",
                         output=scratch_path(spark, "star"), temperatures=paths["temperatures"],
                         demographics=paths["demographics"], country_mapping=paths["mapping"],
                         events_schema=ins["arrivals"].schema,
                         temperatures_schema=ins["temperatures"].schema,
                         demographics_schema=ins["demographics"].schema)
    star = run_pipeline(spark, cfg, B.TEMPERATURE_TIEBREAK, B.DEMOGRAPHICS_TIEBREAK)
    checks = {r.check_name: (r.value, r.passed) for r in star["checks"].collect()}
    clean = clean_arrivals(ins["arrivals"])
    assert checks["immigration_fact"] == (clean.count(), True)
    assert clean.count() < ins["arrivals"].count()
    # NULL codes, visa types and dates never join, by design; that is no fault.
    assert all(passed for _, passed in checks.values())


def test_pipeline_refuses_writing_over_an_input(spark):
    p = scratch_path(spark, "same")
    cfg = PipelineConfig(events=p, output=p, temperatures="x", demographics="y",
                         country_mapping="z")
    spark.range(1).write.parquet(p)
    with pytest.raises(ValueError, match="overwrite"):
        run_pipeline(spark, cfg)
    out = scratch_path(spark, "star")
    for events in (f"{out}/immigration_fact", f"{out}/country/part", out):
        with pytest.raises(ValueError, match="overwrite"):
            build_star(spark, *[spark.range(1)] * 4, out, inputs=[events])


def test_two_runs_over_shuffled_input_agree(spark):
    """Without a tie-break the other columns decide which duplicate stays."""
    def star(n):
        t = B.temperatures(spark, SF).repartition(n, "City")
        d = B.demographics(spark, SF).repartition(n)
        return (sorted(map(str, clean_temperatures(t).collect())),
                sorted(map(str, clean_demographics(d).collect())))
    assert star(3) == star(7)


def test_staged_copy_is_deleted_after_the_block(spark):
    import os

    from starmart.sources.writers import staged
    with staged(spark.range(5), "tmp") as df:
        assert df.count() == 5
        files = df.inputFiles()
    assert files and not any(os.path.exists(f.replace("file:", "", 1)) for f in files)
