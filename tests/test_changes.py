"""Change data, streams against batch, sinks and marts on dirty inputs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe.operators import cdc, incremental, scd2
from tallyframe.operators.joins import left_join_many
from tallyframe.operators.latest import apply_cdc, latest_by
from tallyframe.plans import marts
from tallyframe.sources import changes
from tallyframe.streaming import jobs

MICROS = 1_700_000_000_000_000


def event(i, user, amount, status, op, ms):
    return (i, user, 7, amount, "SAR", status, None, 1, MICROS + i * 1000, op, ms)


EVENTS = [
    event(1, 1, "10.50", "approved", "c", 100), event(1, 1, "10.50", "approved", "c", 100),  # replayed
    event(2, 1, "20.00", "pending", "c", 110), event(2, 1, "25.00", "approved", "u", 130),
    event(2, 1, "22.00", "approved", "u", 120),  # older version arriving late
    event(3, 2, "5.00", "approved", "c", 100), event(3, 2, "5.00", "approved", "d", 140),
    event(4, 2, "7.00", "approved", "c", 100), event(4, 2, "7.00", "approved", "d", 110), event(4, 2, "8.00", "approved", "c", 120),
    event(5, 3, "oops", "approved", "c", 100),
]


@pytest.fixture(scope="module")
def raw(spark):
    from tallyframe.contracts import CHANGE_SCHEMAS

    return spark.createDataFrame(EVENTS, CHANGE_SCHEMAS["transactions"])


def test_typing_and_current_state(raw):
    typed = cdc.type_transactions(raw)
    assert typed.where("transaction_id = 5").first().amount is None
    assert typed.schema["amount"].dataType.simpleString() == "decimal(18,2)"
    state = apply_cdc(typed, ["transaction_id"], ["__source_ts_ms"], op="__op")
    got = {r.transaction_id: r.amount and float(r.amount) for r in state.collect()}
    assert got == {1: 10.5, 2: 25.0, 4: 8.0, 5: None}
    again = latest_by(state, ["transaction_id"], ["__source_ts_ms"])
    assert again.exceptAll(state).count() == 0


def test_audits_keep_the_row(raw):
    out = cdc.delete_audit({"transactions": (cdc.type_transactions(raw), "transaction_id")}).collect()
    assert sorted(r.record_id for r in out) == ["3", "4"]
    assert json.loads(out[0].raw_payload)["user_id"] == 2
    assert cdc.update_audit({"transactions": (raw, "transaction_id")}).count() == 2


def test_exposure_modes(raw):
    typed = cdc.type_transactions(raw)
    every = {r.user_id: float(r.active_exposure or 0) for r in marts.merge_exposure(marts.exposure_partials(typed, F.lit(1))).collect()}
    assert every[1] == 10.5 * 2 + 25 + 22, "each change event counts"
    once = apply_cdc(typed, ["transaction_id"], ["__source_ts_ms"], op="__op")
    assert {r.user_id: float(r.active_exposure or 0) for r in marts.merge_exposure(marts.exposure_partials(once, F.lit(1))).collect()}[1] == 35.5


def test_document_events(spark):
    rows = [
        ("e1", "12", "view", "5", "s", "web", "{'page': 'home'}", "2024-01-01T10:00:00Z"),
        ("e2", "x", "view", "", "s", "web", "{'page': 'p', 'referrer': 'ad', 'geo': {'lat': 24.5, 'lon': 46.1}}", "2024-01-01 10:05:00"),
        ("e3", "1", "view", "z", "s", "web", "{}", "1970-01-01T00:00:00Z"),
        ("e4", "1", "view", "z", "s", "web", "{}", "2299-01-01T00:00:00Z"),
    ]
    df = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, merchant_id string, "
                                     "session_id string, device_type string, event_data string, created_at string")
    typed = cdc.type_app_events(df)
    got = {r.event_id: (r.user_id, r.merchant_id) for r in cdc.silver_app_events(typed).collect()}
    assert got == {"e1": (12, 5), "e2": (0, None), "e4": (1, 0)}
    parsed = {r.event_id: (r.page, r.geo_lat) for r in cdc.parse_event_data(df).collect()}
    assert parsed["e2"] == ("p", 24.5) and parsed["e1"] == ("home", None)
    good, bad = jobs.guard_dates(typed, "created_at", F.lit("2024-06-01").cast("timestamp"))
    assert sorted(r.event_id for r in bad.collect()) == ["e3", "e4"] and good.count() == 2
    (s,) = jobs.sessionize(good, "created_at", session_id="session_id").collect()
    assert (s.events, s.duration_seconds) == (2, 300)


def test_stream_equals_batch(spark, raw, tmp_path):
    """The same events in several files: fan-out, dedup, running sums and latest state."""
    src = str(tmp_path / "in")
    raw.repartition(3).write.json(src)

    def stream():
        return cdc.type_transactions(changes.read_cdc_stream(spark, "transactions", src, max_files_per_trigger=1))

    batch = cdc.type_transactions(raw)
    out = str(tmp_path / "fan")
    jobs.land(stream(), jobs.silver_fanout(out), f"{out}/_checkpoint")
    silver = spark.read.parquet(f"{out}/silver").drop("batch")
    assert silver.exceptAll(cdc.silver_transactions(batch)).count() == 0
    assert silver.count() == cdc.silver_transactions(batch).count()
    assert spark.read.parquet(f"{out}/delete_audit").count() == 2
    merged = marts.merge_exposure(spark.read.parquet(f"{out}/exposure"))
    assert merged.exceptAll(marts.merge_exposure(marts.exposure_partials(batch, F.lit(1)))).count() == 0

    run = str(tmp_path / "run")
    jobs.land_batches(jobs.streaming_exposure(stream()), run, "update")
    final = {r.user_id: r.active_exposure for r in jobs.settled(spark, run, ["user_id"]).collect()}
    assert final == {r.user_id: r.active_exposure for r in jobs.streaming_exposure(batch).collect()}

    once = str(tmp_path / "once")
    timed = stream().withColumn("event_time", F.timestamp_millis("__source_ts_ms"))
    jobs.land_batches(jobs.dedup_replays(timed, ["transaction_id", "__source_ts_ms"], "event_time"), once)
    assert jobs.landed(spark, once).count() == len(EVENTS) - 1

    state = str(tmp_path / "state")
    jobs.land(stream(), jobs.latest_state(state, ["transaction_id"], ["__source_ts_ms"], buckets=4), f"{state}_checkpoint")
    got = {r["transaction_id"]: r["__source_ts_ms"] for r in spark.read.parquet(state).collect()}
    assert got == {1: 100, 2: 130, 3: 140, 4: 120, 5: 100}


def test_replayed_batch_replaces_itself(raw, spark, tmp_path):
    out = str(tmp_path / "fan")
    write = jobs.silver_fanout(out)
    typed = cdc.type_transactions(raw)
    write(typed, 0)
    before = spark.read.parquet(f"{out}/silver").count()
    write(typed, 0)
    assert spark.read.parquet(f"{out}/silver").count() == before


def test_upsert_is_idempotent_and_order_free(spark, tmp_path):
    path = str(tmp_path / "dim")
    new = spark.createDataFrame([(i, i % 3, "new") for i in range(50)], "id int, v int, name string")
    old = spark.createDataFrame([(i, -1, "old") for i in range(60)], "id int, v int, name string")
    for part in (new, old, new):
        sinks.upsert_latest(spark, part, path, ["id"], ["v"], buckets=4)
    out = {r.id: r.name for r in spark.read.parquet(path).collect()}
    assert out == {i: "new" if i < 50 else "old" for i in range(60)}


def test_delete_insert_keeps_other_keys(spark, tmp_path):
    path = str(tmp_path / "mart")
    s = "m int, d string, v int"
    sinks.delete_insert(spark, spark.createDataFrame([(1, "a", 1), (2, "a", 2), (1, "b", 3)], s), path, ["m", "d"], ["d"])
    sinks.delete_insert(spark, spark.createDataFrame([(1, "a", 10)], s), path, ["m", "d"], ["d"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("m", "d", "v").collect()) == [(1, "a", 10), (1, "b", 3), (2, "a", 2)]


def test_scd2_runs(spark):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    mk = lambda rs: spark.createDataFrame(rs, "id int, tier string")
    s1 = scd2.scd2_check(mk([(1, "a"), (2, "b"), (3, None)]), None, "id", ["tier"], at("2024-01-01"))
    s2 = scd2.scd2_check(mk([(1, "x"), (3, None), (4, "n")]), s1, "id", ["tier"], at("2024-02-01"))
    s3 = scd2.scd2_check(mk([(1, "x"), (3, None), (4, "n")]), s2, "id", ["tier"], at("2024-03-01"))
    got = sorted(((r.id, r.tier, r.valid_from.month, r.valid_to and r.valid_to.month) for r in s3.collect()), key=str)
    assert got == [(1, "a", 1, 2), (1, "x", 2, None), (2, "b", 1, 2), (3, None, 1, None), (4, "n", 2, None)]
    assert scd2.scd2_current(s3).count() == 3
    keep = scd2.scd2_check(mk([(1, "a")]), s1, "id", ["tier"], at("2024-02-01"), invalidate_hard_deletes=False)
    assert keep.where("valid_to is not null").count() == 0
    facts = spark.createDataFrame([(9, 1, dt.datetime(2024, 1, 15)), (8, 1, dt.datetime(2024, 2, 1))], "f int, id int, t timestamp_ntz")
    assert {r.f: r.tier for r in scd2.scd2_as_of(s3, facts, "id", "t", ["tier"]).collect()} == {9: "a", 8: "x"}


def test_one_to_many_left_join_with_a_hot_right_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(300)] + [(2, -1), (9, -2)], "k int, r int")
    got = sorted(((r.k, r.l, r.r) for r in left_join_many(left, right, ["k"]).collect()), key=str)
    want = sorted(((r.k, r.l, r.r) for r in left.join(right, ["k"], "left").collect()), key=str)
    assert got == want


def test_settlement_states(spark):
    tx = spark.createDataFrame(
        [(1, 5, 100.0, "approved"), (2, 6, 50.0, "approved"), (3, 7, 80.0, "approved"), (4, 8, 1.0, "declined")],
        "transaction_id int, merchant_id int, amount double, status string",
    ).withColumns({"amount": F.col("amount").cast("decimal(12,2)"), "created_at": F.lit("2024-01-01 09:00:00").cast("timestamp_ntz")})
    repay = spark.createDataFrame([(1, 100.0), (2, 20.0)], "transaction_id int, amount double").withColumns({
        "amount": F.col("amount").cast("decimal(12,2)"), "status": F.lit("paid"),
        "paid_at": F.lit("2024-01-01 18:00:00").cast("timestamp_ntz"),
    })
    got = {r.merchant_id: (r.status, float(r.variance), r.variance_pct) for r in marts.settlement_reconciliation(tx, repay).collect()}
    assert got == {5: ("matched", 0.0, 0.0), 6: ("mismatch", 30.0, 0.6), 7: ("pending", 80.0, 1.0), 8: ("matched", 0.0, 0.0)}


def test_incremental_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in range(1, 11)], "d date, v int")
    assert incremental.incremental_slice(df, None, "d", "3 days").count() == 10
    assert incremental.incremental_slice(df, df.where("v <= 8"), "d", "3 days").count() == 6
    assert incremental.incremental_slice(df, df.where("v < 0"), "d", "3 days").count() == 10
    assert incremental.has_new_rows(df, "v", 9) and not incremental.has_new_rows(df, "v", 10)


@pytest.mark.parametrize("per", [5, 10_000])
def test_batch_sessions_equal_session_windows(spark, per):
    """Pauses of just under, exactly and just over the gap, equal times, and one busy user."""
    minutes = [0, 0, 29, 59, 89.5, 119.5, 149.6, 300] + [1000 + i * 7 for i in range(40)]
    rows = [(u, float(m)) for u in ("busy", "b") for m in minutes]
    df = spark.createDataFrame(rows, "user_id string, m double").select(
        "user_id", F.timestamp_seconds(F.col("m") * 60).alias("t")
    )
    got = jobs.sessionize(df, "t", gap="30 minutes", rows_per_segment=per)
    want = df.groupBy("user_id", F.session_window("t", "30 minutes")).agg(
        F.min("t").cast("timestamp_ntz").alias("first_event"), F.max("t").cast("timestamp_ntz").alias("last_event"),
        F.count(F.lit(1)).alias("events"),
    )
    cols = ["user_id", "first_event", "last_event", "events"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_streamed_sessions_equal_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("a", m) for m in (0, 10, 200, 210)] + [("b", 5)]
    spark.createDataFrame(rows, "user_id string, m int").select(
        "user_id", F.timestamp_seconds(F.col("m") * 60).alias("t")
    ).write.parquet(src)
    stream = spark.readStream.schema("user_id string, t timestamp").parquet(src)
    jobs.land_batches(jobs.sessionize(stream, "t"), out, "complete")
    cols = ["user_id", "first_event", "last_event", "events", "duration_seconds"]
    streamed = jobs.landed(spark, out).select(*cols)
    batch = jobs.sessionize(spark.read.parquet(src), "t").select(*cols)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
