"""Point-in-time features, their gate and their serving."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe.checks import project, runner
from tallyframe.plans import drift, features

SNAP = "2024-06-30 12:00:00"
T = lambda d, h=0: dt.datetime(2024, 6, 30, 12) - dt.timedelta(days=d, hours=h)


@pytest.fixture(scope="module")
def inputs(spark):
    tx = [
        (1, 1, 10, 100.00, "approved", T(0)), (2, 1, 11, 50.01, "declined", T(7)), (3, 1, 10, 20.00, "approved", T(7, 1)),
        (4, 1, 12, 10.00, "approved", T(30)), (5, 1, 13, 999.0, "approved", T(31)), (6, 1, 14, 5.0, "approved", T(-1)),
        (7, 2, 10, 70.0, "approved", T(400)), (8, 3, 10, 1.0, "approved", T(-2)),
    ]
    repay = [
        (1, 1, dt.date(2024, 6, 30), dt.datetime(2024, 6, 30, 23)), (2, 1, dt.date(2024, 5, 1), dt.datetime(2024, 5, 2)),
        (3, 1, dt.date(2024, 3, 31), None), (4, 1, dt.date(2024, 7, 1), dt.datetime(2024, 6, 1)),
        (5, 1, dt.date(2024, 4, 1), None),
    ]
    inst = [(1, 1, "active", T(5)), (2, 1, "completed", T(5)), (3, 1, "active", T(-3)), (4, 2, "active", T(1))]
    ts = lambda df, *cs: df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cs})
    return (
        ts(spark.createDataFrame(tx, "transaction_id int, user_id bigint, merchant_id int, amount double, status string, created_at timestamp_ntz")
           .withColumn("amount", F.col("amount").cast("decimal(12,2)")), "created_at"),
        ts(spark.createDataFrame(repay, "repayment_id int, user_id bigint, due_date date, paid_at timestamp_ntz"), "paid_at"),
        ts(spark.createDataFrame(inst, "schedule_id int, user_id bigint, status string, created_at timestamp_ntz"), "created_at"),
    )


def by_user(df):
    return {r.user_id: r for r in df.collect()}


def test_windows_and_no_leakage(inputs):
    got = by_user(features.compute_features(*inputs, SNAP))
    assert set(got) == {1, 2}, "a user first seen after the snapshot has no row"
    r = got[1]
    assert (r.tx_velocity_7d, r.tx_velocity_30d, r.merchant_diversity_30d) == (2, 4, 3)
    assert float(r.avg_tx_amount_30d) == 45.0
    assert r.declined_rate_7d == 0.5
    assert r.repayment_rate_90d == pytest.approx(1 / 3), "due in 90 days, and paid on the due date is on time"
    assert r.active_installments == 1 and r.days_since_first_tx == 31
    d = got[2]
    assert (d.tx_velocity_30d, float(d.avg_tx_amount_30d), d.declined_rate_7d, d.repayment_rate_90d) == (0, 0.0, 0.0, 0.0)


def test_validity_and_types(inputs):
    df = features.compute_features(*inputs, SNAP, hours=6, version="v9")
    r = by_user(df)[1]
    assert r.valid_from == r.snapshot_ts == dt.datetime(2024, 6, 30, 12)
    assert r.valid_to - r.valid_from == dt.timedelta(hours=6) and r.feature_version == "v9"
    assert df.schema["days_since_first_tx"].dataType.simpleString() == "int"
    assert df.count() == df.select("user_id").distinct().count()


def test_history_equals_single_runs(inputs):
    times = [str(T(-5) - dt.timedelta(hours=60 * k)) for k in range(170, -1, -1)]
    rows = features.compute_feature_history(*inputs, 60, times[0], times[-1]).collect()
    hist = {(r.user_id, r.snapshot_ts): r for r in rows if str(r.snapshot_ts) in times[::13] + times[-12:]}
    assert len(rows) == len({(r.user_id, r.snapshot_ts) for r in rows}) and SNAP in times
    times = times[::13] + times[-12:]
    single = {(r.user_id, r.snapshot_ts): r for t in times for r in features.compute_features(*inputs, t).collect()}
    assert hist == single


def test_history_covers_the_whole_range(inputs):
    """Without bounds: from midnight of the first transaction to the first snapshot after the last one."""
    got = features.compute_feature_history(*inputs, 24 * 30).agg(F.min("snapshot_ts"), F.max("snapshot_ts"), F.count("*")).first()
    first = dt.datetime.combine(T(400).date(), dt.time())
    assert got[0] == first + dt.timedelta(days=30) and T(-2) <= got[1] < T(-2) + dt.timedelta(days=30)


def test_history_of_every_four_hours_meets_brute_force(spark):
    """One month at a cadence of four hours over random facts: nulls, ties, repeated merchants, times before the series."""
    rng = random.Random(5)
    base = dt.datetime(2024, 3, 1)
    when = lambda lo, hi: base + dt.timedelta(seconds=rng.randrange(lo * 86400, hi * 86400))
    tx = [(k, rng.choice([1, 2, 3, None]), rng.choice([7, 8, 9, None]), Decimal(rng.randrange(10_000)) / 100,
           rng.choice(["approved", "declined", None]), when(-45, 31) if k % 20 else base) for k in range(300)]
    repay = [(k, rng.choice([1, 2, 9]), when(-120, 40).date() if k % 9 else None, when(-120, 40) if k % 3 else None) for k in range(200)]
    inst = [(k, rng.choice([1, 2, 3]), rng.choice(["active", "completed"]), when(-40, 40)) for k in range(60)]
    inputs = (
        spark.createDataFrame(tx, "transaction_id int, user_id bigint, merchant_id int, amount decimal(12,2), status string, created_at timestamp_ntz"),
        spark.createDataFrame(repay, "repayment_id int, user_id bigint, due_date date, paid_at timestamp_ntz"),
        spark.createDataFrame(inst, "schedule_id int, user_id bigint, status string, created_at timestamp_ntz"),
    )
    got = {
        (r.user_id, r.snapshot_ts): (r.tx_velocity_7d, r.tx_velocity_30d, float(r.avg_tx_amount_30d), round(r.repayment_rate_90d, 9),
                                     r.merchant_diversity_30d, round(r.declined_rate_7d, 9), r.active_installments, r.days_since_first_tx)
        for r in features.compute_feature_history(*inputs, 4, base, base + dt.timedelta(days=30)).collect()
    }
    want = {}
    for user in (1, 2, 3):
        own = [t for t in tx if t[1] == user]
        for k in range(181):
            s = base + dt.timedelta(hours=4 * k)
            seen = [t for t in own if t[5] <= s]
            if not seen:
                continue
            d30 = [t for t in seen if t[5] >= s - dt.timedelta(days=30)]
            d7 = [t for t in seen if t[5] >= s - dt.timedelta(days=7)]
            due = [r for r in repay if r[1] == user and r[2] and s.date() - dt.timedelta(days=90) <= r[2] <= s.date()]
            mean = (sum(t[3] for t in d30) / len(d30)).quantize(Decimal("0.01"), "ROUND_HALF_UP") if d30 else 0
            want[user, s] = (
                len(d7), len(d30), float(mean),
                round(sum(r[3] is not None and r[3].date() <= r[2] for r in due) / len(due), 9) if due else 0.0,
                len({t[2] for t in d30} - {None}), round(sum(t[4] == "declined" for t in d7) / len(d7), 9) if d7 else 0.0,
                sum(i[1] == user and i[2] == "active" and i[3] <= s for i in inst), (s.date() - min(t[5] for t in seen).date()).days,
            )
    assert got == want and len(want) > 500


def test_history_costs_facts_and_output(inputs):
    """No plan node pairs facts with snapshots: events explode to two or three rows whatever the cadence is."""
    plan = features.compute_feature_history(*inputs, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("explode(array(") == 3 and plan.count("explode(sequence(") == 1


def test_snapshot_time_is_clamped(spark, inputs):
    now = F.lit("2024-08-01 00:00:00").cast("timestamp_ntz")
    tx = inputs[0]
    assert features.derive_snapshot_ts(tx, now).first()[0] == T(-2)
    far = tx.withColumn("created_at", F.lit("2299-12-31").cast("timestamp_ntz"))
    assert features.derive_snapshot_ts(far, now).first()[0] == dt.datetime(2024, 8, 1)


def dirty(df):
    return df.withColumns({
        "tx_velocity_7d": F.when(F.col("user_id") == 2, 9).otherwise(F.col("tx_velocity_7d")),
        "repayment_rate_90d": F.when(F.col("user_id") == 1, 1.5).otherwise(F.col("repayment_rate_90d")),
    })


def test_gate_and_validation(inputs):
    good = features.compute_features(*inputs, SNAP)
    assert project.feature_gate(good).first().passed
    bad = dirty(good)
    r = project.feature_gate(bad).first()
    assert (r.rate_rows, r.velocity_rows, r.null_rows, r.validity_rows, r.passed) == (1, 1, 0, 0, False)
    valid, rejects = project.split_valid(bad)
    assert [x.user_id for x in valid.collect()] == [2], "misordered velocity only warns"
    assert [x.user_id for x in rejects.collect()] == [1]
    now = F.lit(SNAP).cast("timestamp_ntz")
    res = {x.check_name: x.status for x in project.validate_features(bad, now).collect()}
    assert res == {"null_check": "pass", "range_check_non_negative": "pass", "range_check_rates": "warn", "velocity_ordering": "warn"}
    assert runner.evaluate_gate(project.validate_features(bad, now), now).first().gate_open


def test_serving_falls_back_to_latest(spark, inputs):
    hist = features.compute_feature_history(*inputs, 60, "2024-06-28 00:00:00", SNAP)
    asked = [(1, 1, T(0, -1)), (2, 1, T(1)), (3, 1, None), (4, 77, T(0)), (5, 1, T(900))]
    reqs = spark.createDataFrame(asked, "request_id int, user_id bigint, as_of timestamp_ntz")
    got = {r.request_id: (r.match, r.snapshot_ts, r.is_valid) for r in features.serve_as_of(reqs, hist, "v1").collect()}
    newest = dt.datetime(2024, 6, 30, 12)
    assert got == {
        1: ("as_of", newest, True), 2: ("latest", newest, True), 3: ("latest", newest, True),
        4: ("none", None, None), 5: ("latest", newest, True),
    }


def test_drift(spark):
    base = spark.range(100).select(*[F.col("id").cast("double").alias(n) for n in features.FEATURE_NAMES])
    moved = base.withColumn("tx_velocity_7d", F.col("tx_velocity_7d") + 200)
    now = F.lit(SNAP).cast("timestamp_ntz")
    got = {r.feature_name: (round(r.drift_score, 3), r.is_drifted) for r in drift.drift_scores(base, moved, now).collect()}
    assert got["tx_velocity_7d"] == (round(200 / 49.5, 3), 1) and got["tx_velocity_30d"] == (0.0, 0)
    p = {r.feature_name: r.psi for r in drift.psi(base, moved).collect()}
    assert p["tx_velocity_7d"] > 1 and p["tx_velocity_30d"] == pytest.approx(0)


def test_feature_write_creates_then_merges(spark, inputs, tmp_path):
    path = str(tmp_path / "features")
    first = features.compute_features(*inputs, SNAP)
    sinks.merge_features(spark, first, path)
    again = dirty(first)
    later = features.compute_features(*inputs, "2024-07-01 12:00:00", version="v2")
    sinks.merge_features(spark, again.unionByName(later), path)
    out = spark.read.parquet(path)
    assert out.count() == first.count() + later.count()
    assert out.where("user_id = 2 and feature_version = 'v1'").first().tx_velocity_7d == 9
    assert sorted(r.feature_version for r in out.select("feature_version").distinct().collect()) == ["v1", "v2"]


def test_write_refuses_another_schema(spark, inputs, tmp_path):
    path = str(tmp_path / "features")
    df = features.compute_features(*inputs, SNAP)
    sinks.merge_features(spark, df, path)
    with pytest.raises(ValueError, match="retyped=\\['tx_velocity_7d'\\]"):
        sinks.merge_features(spark, df.withColumn("tx_velocity_7d", F.col("tx_velocity_7d").cast("string")), path)
    assert spark.read.parquet(path).count() == df.count()
