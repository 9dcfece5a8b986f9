"""Writes that must not leave a key twice, match positions, and reconciliation of one-sided groups."""

import re

import pytest
from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe.checks import expect
from tallyframe.functions import scalars


def rows(spark, path, *columns):
    return sorted(map(tuple, spark.read.parquet(path).select(*columns).collect()))


def test_a_key_that_moves_partition_is_not_doubled(spark, tmp_path):
    path = f"{tmp_path}/mart"
    write = lambda data: sinks.delete_insert(
        spark, spark.createDataFrame(data, "k int, v string, part string"), path, ["k"], ["part"]
    )
    write([(1, "old", "a"), (2, "old", "a"), (3, "old", "b"), (4, "old", "c")])
    write([(1, "new", "b"), (4, "new", "a")])
    assert rows(spark, path, "k", "v", "part") == [(1, "new", "b"), (2, "old", "a"), (3, "old", "b"), (4, "new", "a")]
    # a partition that lost its last row takes rows again
    write([(9, "new", "c")])
    assert (9, "new", "c") in rows(spark, path, "k", "v", "part")


def test_features_are_unique_across_versions(spark, tmp_path):
    path = f"{tmp_path}/features"
    frame = lambda version, value: spark.sql(
        f"select 1 as user_id, timestamp_ntz'2024-01-01 00:00:00' as valid_from, {value} as x, '{version}' as feature_version"
    )
    sinks.merge_features(spark, frame("v1", 1), path)
    sinks.merge_features(spark, frame("v2", 2), path)
    assert rows(spark, path, "user_id", "x", "feature_version") == [(1, 2, "v2")]


def test_another_bucket_count_is_refused(spark, tmp_path):
    path = f"{tmp_path}/latest"
    batch = spark.range(100).selectExpr("id as k", "1 as version")
    sinks.upsert_latest(spark, batch, path, ["k"], ["version"], buckets=8)
    with pytest.raises(ValueError, match="_bucket_of_8"):
        sinks.upsert_latest(spark, batch, path, ["k"], ["version"], buckets=64)
    sinks.upsert_latest(spark, batch.selectExpr("k", "2 as version"), path, ["k"], ["version"], buckets=8)
    assert rows(spark, path, "k", "version") == [(k, 2) for k in range(100)]


def test_staging_is_removed(spark, tmp_path, monkeypatch):
    made = []
    real = sinks.shared_path
    monkeypatch.setattr(sinks, "shared_path", lambda s, label: made.append(real(s, label)) or made[-1])
    for _ in range(2):
        sinks.delete_insert(spark, spark.createDataFrame([(1, "a")], "k int, part string"), f"{tmp_path}/t", ["k"], ["part"])
    assert made and not any(sinks.read_table(spark, p) for p in made)


@pytest.mark.parametrize(
    ("text", "pattern", "position", "occurrence", "flags"),
    [
        ("a\nb1 c1", "1", 1, 2, ""), ("xA yA", "a", 1, 2, "i"), ("a1b22c333", "([0-9])+", 1, 3, ""), ("a1b22c333", "([0-9])+", 3, 2, ""),
        ("aaa", "a", 1, 4, ""), ("aaa", "a+", 1, 2, ""), ("", "a", 1, 2, ""), ("ab ab ab", "(a)(b)", 2, 2, ""), (None, "a", 1, 2, ""),
        ("é1 é1", "1", 1, 2, ""), ("1start", "1", 1, 1, ""), ("x.y.z.", r"\.", 1, 3, ""),
    ],
)
def test_place_of_a_match(spark, text, pattern, position, occurrence, flags):
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(scalars.regexp_position(F.col("s"), pattern, position, occurrence, flags)).first()[0]
    found = list(re.compile(pattern, re.I if "i" in flags else 0).finditer((text or "")[position - 1 :]))
    want = found[occurrence - 1].start() + position if len(found) >= occurrence else 0
    assert got == (None if text is None else want)


def test_a_missing_side_counts_as_zero(spark):
    a = spark.createDataFrame([("both", 5), ("near", 3), ("far", 30)], "g string, v int")
    b = spark.createDataFrame([("both", 6), ("other", 4)], "g string, v int")
    out = lambda **more: {
        r.col_1: r.expression_difference for r in expect.equal_expression(a, F.sum("v"), b, group_by=["g"], **more).collect()
    }
    assert out() == {"both": 1, "near": 3, "far": 30, "other": 4}
    assert out(tolerance=10) == {"far": 30}
    assert out(tolerance=10, strict=True) == {"near": 3, "far": 30, "other": 4}
    assert out(tolerance_percent=0.5) == {"near": 3, "far": 30}
