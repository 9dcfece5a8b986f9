"""What must not grow faster than the input: joins by cells, placement, the passes of an as-of lookup, events and sketches."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators import asof, ordered
from tallyframe.plans import drift, features
from tallyframe.session import finer_shuffles

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def _versions(spark, path):
    """Stored versions are a small file, whatever they are cut into."""
    rows = [(k, START + 30 * i * DAY, START + (30 * i + (400 if i == 2 else 20)) * DAY, i) for k in range(5) for i in range(12)]
    spark.createDataFrame(rows, "k int, f timestamp_ntz, t timestamp_ntz, val int").write.parquet(path)
    return spark.read.parquet(path), rows


def _requests(spark):
    asks = [(i, i % 7, START + i * 3 * DAY) for i in range(140)]
    return spark.createDataFrame(asks, "id int, k int, at timestamp_ntz"), asks


def _want(rows, asks):
    return {i: max(((f, v) for vk, f, t, v in rows if vk == k and f <= at < t), default=(None, None))[1] for i, k, at in asks}


def test_cells_are_joined_without_a_broadcast(spark, tmp_path):
    versions, rows = _versions(spark, str(tmp_path / "v"))
    requests, asks = _requests(spark)
    out = asof.asof_range_join(requests, versions, ["k"], ["id"], "at", "f", "t", ["val"])
    joins = [line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line and "cell" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    assert {r.id: r.val for r in out.collect()} == _want(rows, asks)


def test_a_range_of_any_length_lies_in_two_cells(spark):
    spans = [(a, a + n) for a in (-90_001, -1, 0, 7, 8, 12_345) for n in (0, 1, 2, 3, 7, 8, 400, 3_652, 70_000)]
    df = spark.createDataFrame(spans, "a bigint, b bigint").withColumn("_level", asof.cell_level(F.col("a"), F.col("b")))
    for r in df.collect():
        assert (r.b >> r._level) - (r.a >> r._level) <= 1
        assert r._level == 0 or r.b - r.a + 1 > 1 << (r._level - 1), "no smaller level would do"


def test_the_stream_of_an_as_of_lookup_is_placed_once(spark, tmp_path, monkeypatch):
    versions, rows = _versions(spark, str(tmp_path / "v"))
    requests, asks = _requests(spark)
    stored, plain = [], ordered._stored
    monkeypatch.setattr(ordered, "_stored", lambda df, label: stored.append(label) or plain(df, label))
    for per in (20, 100_000):
        stored.clear()
        out = asof.asof_join(requests, versions, ["k"], "at", "f", "t", ["val"], rows_per_segment=per)
        assert {r.id: r.val for r in out.collect()} == _want(rows, asks)
        assert stored == ["rows-to-place"]


def test_only_keys_beyond_a_segment_are_cut(spark):
    """Small keys are neither stored a second time nor cut; the hot one is."""
    small = spark.range(3000).selectExpr("id % 300 as k", "id as t")
    placed = ordered.place(small, ["k"], ["t"], 100)
    assert [r[0] for r in placed.select(ordered.SEGMENT).distinct().collect()] == [ordered.WHOLE]
    both = ordered.place(small.unionByName(spark.range(1000).selectExpr("-1L as k", "id as t")), ["k"], ["t"], 100)
    cut = {r.k for r in both.where(F.col(ordered.SEGMENT) > ordered.WHOLE).select("k").distinct().collect()}
    assert -1 in cut and len(cut) < 10
    assert both.where("k = -1").groupBy(ordered.SEGMENT).count().agg(F.max("count")).first()[0] <= 100
    out = ordered.with_previous(both, ["k"], ["t"], ["t"], "p")
    assert out.where("p is null").count() == 301 and out.count() == 4000


def test_events_hold_no_wide_decimal(spark):
    tx = spark.createDataFrame([(1, 1, "10.05", "approved", START)], "user_id bigint, merchant_id int, amount string, status string, created_at timestamp_ntz")
    tx = tx.withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    events = features._transaction_events(tx, features.SnapshotSeries(tx, 24, None, None))
    assert not [f.name for f in events.schema if isinstance(f.dataType, T.DecimalType)]


def test_half_a_cent_rounds_away_from_zero(spark):
    amounts = [(1, "0.01"), (1, "0.02"), (2, "-0.01"), (2, "-0.02"), (3, "10.00"), (3, "0.00"), (3, "0.01"), (4, None)]
    rows = [(k, 1, a, "approved", START) for k, a in amounts]
    tx = spark.createDataFrame(rows, "user_id bigint, merchant_id int, amount string, status string, created_at timestamp_ntz")
    tx = tx.withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    none = (
        spark.createDataFrame([], "user_id bigint, due_date date, paid_at timestamp_ntz"),
        spark.createDataFrame([], "user_id bigint, status string, created_at timestamp_ntz"),
    )
    got = {r.user_id: str(r.avg_tx_amount_30d) for r in features.compute_feature_history(tx, *none, 24, START, START).collect()}
    assert got == {1: "0.02", 2: "-0.02", 3: "3.34", 4: "0.00"}


def test_sketches_take_one_group_per_snapshot(spark):
    rows = [(START + (i % 3) * DAY, float(i) if i % 3 else None, i) for i in range(30)]
    df = spark.createDataFrame(rows, "snapshot_ts timestamp_ntz, a double, b int")
    out = drift.feature_sketches(df, ["a", "b"])
    assert "feature_name" not in "".join(
        line.split("functions")[0] for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Aggregate(key" in line
    )
    got = {(r.snapshot_ts, r.feature_name): r.rows for r in out.collect()}
    assert got == {(START + d * DAY, n): 10 for d in range(3) for n in ("a", "b") if d or n == "b"}


def test_shuffles_get_finer_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with finer_shuffles(spark, 10_000_000, 100_000):
        assert spark.conf.get(key) == "100"
    assert spark.conf.get(key, None) == before
