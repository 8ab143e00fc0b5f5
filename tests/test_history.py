"""Type-2 history: versions never overlap, any day can be restored, reruns do nothing."""

import random

import pytest

from starmart.config import scratch_path
from starmart.plans.history import as_of, attribute_hash, read_history, update_history

SCHEMA = "k string, region string, n int, name string"
KEYS = ["k", "region"]


def snapshots(days=5):
    rng = random.Random(6)
    out = []
    for _ in range(days):
        keys = [(k, r) for k in ["a", "b", "c", None] for r in ["x", None] if rng.random() < .7]
        out.append([(*k, rng.choice([None, 1, 2]), rng.choice(["", "n", None])) for k in keys])
    return out


def rows(df):
    return sorted(map(str, df.collect()))


def test_every_day_can_be_restored(spark):
    path, days = scratch_path(spark, "history"), snapshots()
    frames = [spark.createDataFrame(s, SCHEMA) for s in days]
    for n, f in enumerate(frames):
        once = rows(update_history(spark, path, f, KEYS, f"2016-01-{n + 1:02}"))
        history = update_history(spark, path, f, KEYS, f"2016-01-{n + 1:02}")
        assert rows(history) == once
    for n, f in enumerate(frames):
        assert rows(as_of(history, f"2016-01-{n + 1:02}").select(*f.columns)) == rows(f)
    spans = {}
    for r in history.collect():
        assert r.valid_to is None or r.valid_from < r.valid_to
        spans.setdefault((r.k, r.region), []).append((r.valid_from, r.valid_to))
    for of_key in spans.values():
        of_key.sort()
        for (_, end), (start, _) in zip(of_key, of_key[1:]):
            assert end is not None and end <= start
    with pytest.raises(ValueError):
        update_history(spark, path, frames[0], KEYS, "2016-01-03")


def test_a_day_may_be_corrected(spark):
    """The second snapshot of a day replaces the first, also where that closed rows."""
    path = scratch_path(spark, "history")
    one = spark.createDataFrame([("a", "x", 1, "n"), ("b", "x", 1, "n")], SCHEMA)
    update_history(spark, path, one, KEYS, "2016-01-01")
    changed = spark.createDataFrame([("a", "x", 2, "n")], SCHEMA)
    closed = update_history(spark, path, changed, KEYS, "2016-01-02")
    assert closed.where("valid_to IS NOT NULL").count() == 2
    assert rows(update_history(spark, path, one, KEYS, "2016-01-02")) == rows(
        as_of(read_history(spark, path), "2016-01-01").selectExpr(
            "*", "DATE '2016-01-01' valid_from", "CAST(NULL AS DATE) valid_to"))
    gone = update_history(spark, path, one.limit(0), KEYS, "2016-01-03")
    assert gone.count() == 2 and gone.where("valid_to IS NULL").count() == 0
    assert update_history(spark, path, one, KEYS, "2016-01-04").count() == 4


def test_hash_tells_values_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", None), (None, ""), ("-", "-"),
                                (None, None)], "a string, b string")
    assert df.select(attribute_hash(["a", "b"]).alias("h")).distinct().count() == 6
    assert df.select(attribute_hash([]).alias("h")).distinct().count() == 1
