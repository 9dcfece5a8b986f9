"""States that are stored, replaced and merged."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import states
from tallyframe.plans import drift, features

SPEC = states.StateSpec(["k"], sums={"m": "m"}, distinct={"u": "u"}, members={"w": "u"}, quantiles={"v": "v"})


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(2)
    rows = [(f"2024{m:02d}", rng.choice("ab"), rng.randrange(4000) + 500 * m, rng.randrange(10_000) / 100, rng.gauss(0, 1)) for m in range(1, 7) for _ in range(3000)]
    rows += [("202401", None, None, None, None)]
    return rows, spark.createDataFrame(rows, "p string, k string, u int, m double, v double").withColumn("m", F.col("m").cast("decimal(12,2)"))


def test_merged_states_meet_the_facts(spark, facts, tmp_path):
    rows, df = facts
    path = str(tmp_path / "s")
    states.replace_periods(states.build_states(df, F.col("p"), SPEC), path)
    got = {r.k: r for r in states.answers(states.merge_states(states.read_states(spark, path), SPEC), SPEC, {"q1": 0.25, "q9": 0.9}).collect()}
    for k in ("a", "b"):
        own = [r for r in rows if r[1] == k]
        users, values = {r[2] for r in own}, sorted(r[4] for r in own)
        assert got[k].rows == len(own) and float(got[k].sum_m) == pytest.approx(sum(r[3] for r in own))
        assert abs(got[k].u - len(users)) <= len(users) * states.hll_bound()
        assert abs(got[k].w - len(users)) <= len(users) * 0.06
        for name, q in (("v_q1", 0.25), ("v_q9", 0.9)):
            rank = sum(x <= got[k][name] for x in values) / len(values)
            assert abs(rank - q) <= states.kll_bound() + 1 / len(values)
    assert got[None].rows == 1 and got[None].u == 0


def test_a_period_is_replaced_whole_and_others_stay(spark, facts, tmp_path):
    rows, df = facts
    path = str(tmp_path / "s")
    states.replace_periods(states.build_states(df.where("p <> '202403' or u % 2 = 0"), F.col("p"), SPEC), path)
    for _ in range(2):
        states.replace_periods(states.build_states(df.where("p = '202403'"), F.col("p"), SPEC), path)
    got = {(r.period, r.k): r.rows for r in states.read_states(spark, path).collect()}
    want = {}
    for r in rows:
        want[r[0], r[1]] = want.get((r[0], r[1]), 0) + 1
    assert got == want
    assert states.read_states(spark, str(tmp_path / "none")) is None


def test_states_merge_in_any_grouping(spark, facts, tmp_path):
    rows, df = facts
    built = states.build_states(df, F.col("p"), SPEC)
    halves = states.merge_states(built.withColumn("h", F.substring("period", 6, 1).cast("int") % 2), SPEC, ["h", "k"])
    whole = states.answers(states.merge_states(halves, SPEC, ["k"]), SPEC)
    once = states.answers(states.merge_states(built, SPEC), SPEC)
    a, b = ({r.k: r for r in df.collect()} for df in (whole, once))
    for k in a:
        assert (a[k].rows, a[k].sum_m) == (b[k].rows, b[k].sum_m)
        # estimates depend on the order of merging, within the bound
        assert abs(a[k].u - b[k].u) <= 2 * states.hll_bound() * b[k].u


def test_retained_members(facts):
    rows, df = facts
    built = states.build_states(df, F.col("p"), SPEC)
    got = {r.k: r for r in states.retained(built, SPEC, "w", F.col("period") <= "202402", F.col("period") >= "202405").collect()}
    for k in ("a", "b"):
        a = {r[2] for r in rows if r[1] == k and r[0] <= "202402"}
        b = {r[2] for r in rows if r[1] == k and r[0] >= "202405"}
        for name, n in (("members_before", len(a)), ("members_after", len(b)), ("members_both", len(a & b))):
            assert abs(got[k][name] - n) <= 0.06 * len(a | b), name


def test_psi_from_sketches(spark):
    """Shares of bins from sketches, and no reading of rows: the input has sketches only."""
    names = features.FEATURE_NAMES
    base = spark.range(20_000).select(F.lit("a").alias("snapshot_ts"), *[(F.col("id") * (i + 1) % 997).cast("double").alias(n) for i, n in enumerate(names)])
    moved = base.withColumns({"snapshot_ts": F.lit("b"), names[0]: F.col(names[0]) + 300, names[1]: F.lit(5.0)})
    sketches = drift.feature_sketches(base.unionByName(moved))
    assert sketches.columns == ["snapshot_ts", "feature_name", "rows", "sketch"] and sketches.count() == 16
    near = {r.feature_name: r for r in drift.psi_from_sketches(sketches.where("snapshot_ts = 'a'"), sketches.where("snapshot_ts = 'b'")).collect()}
    exact = {r.feature_name: r.psi for r in drift.psi(base, moved).collect()}
    assert near[names[0]].psi == pytest.approx(exact[names[0]], rel=0.1) and near[names[2]].psi < 0.001
    values = sorted(r[0] for r in base.select(names[0]).collect())
    low = [0.0] + list(near[names[0]].edges)
    for i, s in enumerate(near[names[0]].shares_baseline):
        share = sum((x > low[i] or i == 0) and (i + 1 >= len(low) or x <= low[i + 1]) for x in values) / len(values)
        assert abs(s - share) <= drift.share_bound()
