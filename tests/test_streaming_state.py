"""Streams with state: repeats and late rows accounted for, replays without effect."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from starmart.config import scratch_path
from starmart.streaming import dedup, windows

EVENTS = "k long, ts timestamp, v string"
HOUR = dt.timedelta(hours=1)
START = dt.datetime(2024, 1, 1)


def deliver(spark, drops, delay="5 hours"):
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "events")
    schema = spark.createDataFrame([], EVENTS).schema
    for rows in drops:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(landing)
        dedup.ingest_events(spark, landing, table, schema, ["k"], "ts", delay)
    return table, dedup.outcomes(spark, table, ["k"], "ts")


def brute(drops, delay):
    out, seen, clock = Counter(), set(), None
    for rows in drops:
        mark = clock - delay if clock else None
        for k, ts, _ in rows:
            if ts is None or (mark and ts <= mark):
                out[k, ts, "late"] += 1
            else:
                out[k, ts, "repeated" if (k, ts) in seen else "kept"] += 1
                seen.add((k, ts))
        clock = max([t for _, t, _ in rows if t] + ([clock] if clock else []), default=None)
    return out


def test_every_row_is_kept_repeated_or_late(spark):
    rng = random.Random(4)
    drops, past = [], []
    for d in range(4):
        rows = [(rng.randrange(40), START + HOUR * rng.randint(6 * d, 6 * d + 9), "x")
                for _ in range(60)]
        rows += rng.sample(past, min(len(past), 25)) + [(None, START + HOUR * 6 * d, "x"), (d, None, "x")]
        past += rows
        drops.append(rows)
    drops.append([(99, START + HOUR * 13 + dt.timedelta(microseconds=n), "edge") for n in (0, 1)])
    table, got = deliver(spark, drops)
    got = {(r.k, r.ts, r.outcome): r.n for r in got.collect()}
    assert got == dict(brute(drops, 5 * HOUR))
    assert sum(got.values()) == sum(map(len, drops))
    assert {o for _, _, o in got} == {"kept", "repeated", "late"}
    kept = spark.read.parquet(f"{table}/kept")
    assert kept.count() == kept.dropDuplicates(["k", "ts"]).count()


def test_a_batch_that_runs_again_replaces_what_it_wrote(spark):
    table = scratch_path(spark, "events")
    batches = [[(1, START + HOUR * 20, "a"), (2, START, "b")], [(3, START, "c"), (4, START + HOUR * 19, "d")]]
    for i in (0, 1, 1, 0, 1):
        rows = spark.createDataFrame(batches[i], EVENTS)
        dedup.split_batch(rows, i, table, "ts", "5 hours")
    read = lambda n: sorted(r.k for r in spark.read.parquet(f"{table}/{n}").collect())
    assert (read("on_time"), read("late")) == ([1, 2, 4], [3])


def test_state_is_dropped_behind_the_watermark(spark):
    """Keys older than the delay leave the state store."""
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "events")
    schema = spark.createDataFrame([], EVENTS).schema
    for d in range(3):
        rows = [(k, START + HOUR * 100 * d, "x") for k in range(50)]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(landing)
        dedup.split_late(spark, landing, table, schema, "ts", "5 hours").awaitTermination()
        query = dedup.keep_first(spark, table, schema, ["k"], "ts", "5 hours")
        query.awaitTermination()
    held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert held <= 50


def content(spark, table):
    return sorted(map(str, spark.read.parquet(table).collect()))


def test_upserts_replace_by_key_and_batch(spark):
    table = scratch_path(spark, "weeks")
    frame = lambda rows: spark.createDataFrame(rows, "week string, n long, year int")
    first, second = [("a", 1, 1), ("b", 2, 2), (None, 5, 1)], [("a", 4, 1), ("c", 1, 1)]
    windows.upsert(frame(first), 0, table, ["week", "year"], "year")
    windows.upsert(frame(second), 1, table, ["week", "year"], "year")
    after = content(spark, table)
    assert {(r.week, r.n, r.batch) for r in spark.read.parquet(table).collect()} == {
        ("a", 4, 1), ("b", 2, 0), ("c", 1, 1), (None, 5, 0)}
    for batch, rows in ((1, second), (0, first)):  # again, also an older one
        windows.upsert(frame(rows), batch, table, ["week", "year"], "year")
        assert content(spark, table) == after
    windows.upsert(frame(second).limit(0), 2, table, ["week", "year"], "year")
    assert content(spark, table) == after


def test_weeks_of_a_stream_equal_the_batch(spark):
    schema = "arrdate double, i94addr string"
    sas = lambda n: 16000.0 + n
    drops = [[(sas(n), "NY") for n in range(20)] + [(None, "NY"), (sas(3), None)],
             [(sas(n), "CA") for n in range(15, 40)]]
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "weekly")
    for rows in drops:
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(landing)
        windows.stream_weekly_arrivals(spark, landing, table, df.schema).awaitTermination()
    whole = spark.createDataFrame([r for d in drops for r in d], schema)
    expected = windows.weekly_arrivals(whole, "60 days").select("week", "state_code", "arrivals")
    got = spark.read.parquet(table).select("week", "state_code", "arrivals")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert all(r.week.weekday() == 0 for r in got.collect())
    assert got.agg(F.sum("arrivals")).first()[0] == 46
