import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from starmart.config import ensure_shared_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "4g")
         # One session runs thousands of jobs: forget the finished ones.
         .config("spark.ui.retainedJobs", "20").config("spark.ui.retainedStages", "20")
         .config("spark.ui.retainedTasks", "500").config("spark.sql.ui.retainedExecutions", "5")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(s)  # tests only: a /tmp folder when none is configured
    yield s
