"""Stream state, late rows and metrics: out-of-order input, replays, and what a batch writes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.streaming import jobs

NOW = "2024-06-30 12:00:00"
T0 = dt.datetime(2024, 6, 1)


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(schema).parquet(f"{path}/in")


SCHEMA = "k int, v int, gone boolean, note string"


def test_keyed_state_takes_the_newest_row_in_any_order(spark, tmp_path):
    rng, path, seen = random.Random(1), str(tmp_path), {}
    for batch in range(4):
        rows = [(rng.randrange(40), v, rng.random() < 0.2, None if v % 5 else f"n{v}") for v in rng.sample(range(10_000 * batch % 17, 5_000), 60)]
        jobs.land_state(jobs.keyed_state(feed(spark, path, rows, SCHEMA), ["k"], ["v"]), path)
        for r in rows:
            seen[r[0]] = max(seen.get(r[0], r), r, key=lambda x: x[1])
        last = jobs.landed(spark, path).where(F.col("batch") == batch).select("k").collect()
        assert sorted(r.k for r in last) == sorted({r[0] for r in rows}), "a batch puts out its own keys, each once"
        if batch == 2:
            jobs.fold_state(spark, path, ["k"], ["v"])
    want = sorted(seen.values())
    assert sorted(tuple(r) for r in jobs.current_state(spark, path, ["k"], ["v"]).select("k", "v", "gone", "note").collect()) == want
    for _ in range(2):
        jobs.fold_state(spark, path, ["k"], ["v"])
    alive = jobs.current_state(spark, path, ["k"], ["v"], F.col("gone")).select("k", "v", "gone", "note").collect()
    assert sorted(tuple(r) for r in alive) == [r for r in want if not r[2]]


def test_state_store_setting_is_put_back(spark, tmp_path):
    before = spark.conf.get(jobs.STATE_STORE, None)
    jobs.land_state(jobs.keyed_state(feed(spark, str(tmp_path), [(1, 1, False, "x")], SCHEMA), ["k"], ["v"]), str(tmp_path))
    assert spark.conf.get(jobs.STATE_STORE, None) == before


def test_state_is_written_without_counting_its_keys(spark, tmp_path, monkeypatch):
    seen, plain = [], jobs.land_batches
    monkeypatch.setattr(jobs, "land_batches", lambda s, *rest: seen.append(spark.conf.get(jobs.COUNT_KEYS)) or plain(s, *rest))
    before = spark.conf.get(jobs.COUNT_KEYS, None)
    jobs.land_state(jobs.keyed_state(feed(spark, str(tmp_path), [(1, 1, False, "x")], SCHEMA), ["k"], ["v"]), str(tmp_path))
    assert seen == ["false"] and spark.conf.get(jobs.COUNT_KEYS, None) == before


def test_a_finished_fold_is_read_as_it_is(spark, tmp_path):
    """Newer batches join the fold, older ones are not read again; a fold without its mark counts with all batches."""
    path = str(tmp_path)

    def add(*rows):
        jobs.land_state(jobs.keyed_state(feed(spark, path, rows, SCHEMA), ["k"], ["v"]), path)

    def state():
        return jobs.current_state(spark, path, ["k"], ["v"], F.col("gone")).select("k", "v")

    add((1, 1, False, "a"), (2, 5, False, "b"))
    add((1, 3, False, "c"), (3, 1, True, "d"))
    jobs.fold_state(spark, path, ["k"], ["v"])
    assert sorted(map(tuple, state().collect())) == [(1, 3), (2, 5)]
    assert "Window" not in state()._jdf.queryExecution().optimizedPlan().toString()
    add((2, 9, False, "e"), (3, 2, False, "f"))
    assert sorted(map(tuple, state().collect())) == [(1, 3), (2, 9), (3, 2)]
    (tmp_path / "folded" / "fold=1" / "_SUCCESS").unlink()
    assert sorted(map(tuple, state().collect())) == [(1, 3), (2, 9), (3, 2)]


EVENTS = "id int, user_id int, created_at timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def land(spark, path, rows):
    jobs.land_timely(feed(spark, path, rows, EVENTS), path, "created_at", F.lit(NOW).cast("timestamp_ntz"), "1 hour")


def test_every_row_lands_or_becomes_a_dead_letter(spark, tmp_path):
    path = str(tmp_path)
    batches = [
        [(1, 1, at(0)), (2, 1, at(200)), (3, 1, None), (4, 1, dt.datetime(2299, 1, 1))],
        [(5, 1, at(139)), (6, 1, at(140)), (7, 2, at(300)), (8, 2, dt.datetime(1970, 1, 1))],
        [(9, 2, dt.datetime(2298, 1, 1))],
        [(10, 2, at(241)), (11, 2, at(239))],
    ]
    for rows in batches:
        land(spark, path, rows)
    got = [tuple(r) for r in jobs.ledger(spark, path).orderBy("batch").select("rows_in", "landed", "bad", "late").collect()]
    assert got == [(4, 2, 2, 0), (4, 2, 1, 1), (1, 0, 1, 0), (2, 1, 0, 1)]
    dead = {r.id: r.reason for r in jobs.dead_letters(spark, path).collect()}
    assert dead == {3: jobs.BAD_DATE, 4: jobs.BAD_DATE, 8: jobs.BAD_DATE, 9: jobs.BAD_DATE, 5: jobs.LATE, 11: jobs.LATE}
    good = jobs.timely_stream(spark, path, spark.createDataFrame([], EVENTS).schema)
    assert good.isStreaming and spark.read.parquet(f"{path}/rows").where("kind = 'good'").count() == 5


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    """The writer decides by the ledger of earlier batches only, so running a batch again changes nothing."""
    path = str(tmp_path)
    land(spark, path, [(1, 1, at(0)), (2, 1, at(200))])
    land(spark, path, [(3, 1, at(100)), (4, 1, at(400))])
    state = lambda: (sorted(map(tuple, jobs.ledger(spark, path).collect())), sorted(r.id for r in jobs.dead_letters(spark, path).collect()))
    before = state()
    # the second batch once more, as after a crash before its commit
    (tmp_path / "_checkpoint" / "commits" / "1").unlink()
    (tmp_path / "_checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    stream = spark.readStream.schema(EVENTS).parquet(f"{path}/in")
    jobs.land_timely(stream, path, "created_at", F.lit(NOW).cast("timestamp_ntz"), "1 hour")
    assert state() == before and before[1] == [3]


@pytest.mark.parametrize("shuffled", [False, True])
def test_sessions_by_event_time_equal_a_batch_over_the_landed_rows(spark, tmp_path, shuffled):
    rng, path = random.Random(7), str(tmp_path)
    rows = [(i, rng.randrange(4), at(rng.randrange(6000))) for i in range(160)]
    slices = [[r for r in rows if 1500 * s <= (r[2] - T0).total_seconds() / 60 < 1500 * (s + 1)] for s in range(4)]
    if shuffled:
        # some rows come much too late
        slices = [slices[0][5:], slices[1], slices[0][:5] + slices[2], slices[3]]
    schema = spark.createDataFrame([], EVENTS).schema
    for part in slices:
        land(spark, path, part)
        jobs.land_sessions(spark, path, schema, "created_at", gap="30 minutes")
    jobs.close_sessions(spark, path, schema, "created_at")
    jobs.land_sessions(spark, path, schema, "created_at", gap="30 minutes")
    got = sorted(tuple(r) for r in jobs.landed(spark, f"{path}/sessions").drop("batch").collect())
    dead = {r.id for r in jobs.dead_letters(spark, path).collect()}
    assert len(dead) == (5 if shuffled else 0)
    batch = jobs.sessionize(spark.createDataFrame([r for r in rows if r[0] not in dead], EVENTS), "created_at", gap="30 minutes")
    assert got == sorted(tuple(r) for r in batch.collect()) and len(got) > 50


def test_metrics_come_from_the_pass_that_writes(spark, tmp_path):
    path = str(tmp_path)
    for rows in ([(1, 1, at(5)), (2, 1, at(3))], [(3, 1, at(9))], [(4, 1, None)]):
        jobs.land(feed(spark, path, rows, EVENTS), jobs.observed_batches(path, "created_at"), f"{path}/_checkpoint")
    got = [tuple(r) for r in spark.read.parquet(f"{path}/metrics").orderBy("batch").select("rows", "oldest", "newest").collect()]
    assert got == [(2, at(3), at(5)), (1, at(9), at(9)), (1, None, None)]
    assert spark.read.parquet(f"{path}/data").count() == 4
