"""The original job's entry points, run over files, give the same star."""

from starmart import compat
from starmart.config import scratch_path
from starmart.sources import bindings as B

SF = "/root/testdata/sf0.001"


def test_original_entry_points(spark):
    ins = {"arrivals": B.arrivals(spark, SF), "temperatures": B.temperatures(spark, SF),
           "demographics": B.demographics(spark, SF), "mapping": B.country_mapping(spark, SF)}
    base = scratch_path(spark, "input") + "/"
    ins["arrivals"].write.parquet(base + "events")
    ins["temperatures"].write.option("header", True).csv(base + "temps.csv")
    ins["demographics"].write.option("header", True).option("sep", ";").csv(base + "demo.csv")
    out = scratch_path(spark, "out") + "/"
    tables = compat.process_input_data(
        spark, base, out, "events", "temps.csv", ins["mapping"],
        events_schema=ins["arrivals"].schema, temperatures_schema=ins["temperatures"].schema,
        temperature_order=B.TEMPERATURE_TIEBREAK)
    demo = compat.process_demographics_data(spark, base, out, "demo.csv",
                                            demographics_schema=ins["demographics"].schema,
                                            demographics_order=B.DEMOGRAPHICS_TIEBREAK)
    assert tables["immigration_fact"].count() == compat.clean_immigration_df(ins["arrivals"]).count()
    assert compat.get_visa_type_dimension(spark, out).count() == tables["visatype"].count()
    assert demo.count() == compat.clean_demographics_df(
        ins["demographics"], order_by=B.DEMOGRAPHICS_TIEBREAK).count()
    checks = {r.check_name: r.passed for r in compat.do_quality_check(tables).collect()}
    assert checks["immigration_fact"] and checks["visatype"] and checks["country"]
    assert compat.count_check(tables["country"], "country").first().passed
    # Step by step, as the original driver called them.
    events = compat.clean_immigration_df(ins["arrivals"])
    out2 = scratch_path(spark, "out2")
    visa = compat.create_visa_type_df(events, out2)
    fact = compat.create_immigration_fact_table(spark, events, out2)
    assert sorted(r.visa_type_key for r in visa.collect()) == list(range(visa.count()))
    assert fact.count() == events.count()
    assert compat.create_immigration_time_df(events, out2).count() == \
        tables["immigration_calendar"].count()
    assert compat.missing_values_spark(events).count() == len(events.columns)


def test_command_line(spark):
    from pyspark.sql import functions as F

    from starmart import schemas
    from starmart.__main__ import main
    from starmart.operators.clean import clean_arrivals
    base = scratch_path(spark, "cli")
    arrivals = B.arrivals(spark, SF)
    # Full source layouts: every column of the data dictionaries, as the CLI reads them.
    full = arrivals.select(*[arrivals[f.name] if f.name in arrivals.columns
                             else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in schemas.ARRIVALS.fields])
    full.write.parquet(f"{base}/events")
    temps = B.temperatures(spark, SF).select(
        "dt", "AverageTemperature", F.lit(None).cast("double").alias("AverageTemperatureUncertainty"),
        "City", "Country", F.lit(None).cast("string").alias("Latitude"),
        F.lit(None).cast("string").alias("Longitude"))
    temps.write.option("header", True).csv(f"{base}/temps")
    B.demographics(spark, SF).drop("c_custkey").write.option("header", True) \
        .option("sep", ";").csv(f"{base}/demo")
    B.country_mapping(spark, SF).write.option("header", True).csv(f"{base}/map")
    out = f"{base}/star"
    assert main(["--events", f"{base}/events", "--temperatures", f"{base}/temps",
                 "--demographics", f"{base}/demo", "--mapping", f"{base}/map",
                 "--output", out, "--strict"], spark) == 0
    fact = spark.read.parquet(f"{out}/immigration_fact")
    assert fact.count() == clean_arrivals(arrivals).count()
    assert "record_id" in fact.columns and "visatype" not in fact.columns
    # The same events as CSV give the same fact.
    full.write.option("header", True).option("sep", "|").csv(f"{base}/events_csv")
    assert main(["--events", f"{base}/events_csv", "--events-format", "csv",
                 "--events-option", "sep=|", "--temperatures", f"{base}/temps",
                 "--demographics", f"{base}/demo", "--mapping", f"{base}/map",
                 "--output", f"{base}/star2"], spark) == 0
    again = spark.read.parquet(f"{base}/star2/immigration_fact")
    assert sorted(map(str, again.select(*fact.columns).collect())) == sorted(map(str, fact.collect()))
