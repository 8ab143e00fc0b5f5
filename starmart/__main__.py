"""Command line: build the star from files, as the original job did under
``spark-submit``.

    spark-submit --conf spark.checkpoint.dir=hdfs:///tmp/ckpt starmart/__main__.py \\
        --events s3://in/arrivals/ --events-format parquet \\
        --temperatures s3://in/temperatures.csv --demographics s3://in/demographics.csv \\
        --mapping s3://in/country_codes.csv --output s3://out/star/

The session comes from ``spark-submit`` (master, memory, checkpoint folder);
the quality checks are printed and, with ``--strict``, fail the run.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="starmart", description=__doc__.splitlines()[0])
    p.add_argument("--events", required=True)
    p.add_argument("--events-format", default="parquet")
    p.add_argument("--events-option", action="append", default=[], metavar="KEY=VALUE",
                   help="option of the events' reader, repeatable (CSV has a header by default)")
    p.add_argument("--temperatures", required=True)
    p.add_argument("--demographics", required=True)
    p.add_argument("--mapping", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--temperature-order", default="",
                   help="comma-separated tie-break columns for duplicate readings")
    p.add_argument("--demographics-order", default="",
                   help="comma-separated tie-break columns for duplicate demographics rows")
    p.add_argument("--strict", action="store_true", help="fail when a quality check fails")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from starmart.plans.pipeline import run_pipeline
    from starmart.plans.quality import assert_quality
    from starmart.sources.readers import PipelineConfig

    a = parse(argv)
    spark = spark or SparkSession.builder.appName("starmart").getOrCreate()
    options = dict(o.split("=", 1) for o in a.events_option)
    cfg = PipelineConfig(events=a.events, events_format=a.events_format, output=a.output,
                         events_options=options,
                         temperatures=a.temperatures, demographics=a.demographics,
                         country_mapping=a.mapping)
    split = lambda s: [c for c in s.split(",") if c] or None
    star = run_pipeline(spark, cfg, split(a.temperature_order), split(a.demographics_order))
    checks = star["checks"]
    checks.show(truncate=False)
    if a.strict:
        assert_quality(checks)
    return 0


if __name__ == "__main__":
    sys.exit(main())
