"""Segmented look-back against brute force, with one key holding most rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import asof, ordered, quantiles, scd2, tables


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    keys = ["hot"] * 400 + ["a"] * 60 + [None] * 80 + ["b"]
    out = [(k, rng.randint(0, 120), i, rng.choice([None, 1, 2, 3])) for i, k in enumerate(keys)]
    rng.shuffle(out)
    return out


def groups(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    return by


@pytest.mark.parametrize("per", [10, 37, 10_000])
def test_previous_and_next(spark, rows, per):
    df = spark.createDataFrame(rows, "k string, t int, id int, v int").repartition(5)
    prev = ordered.with_previous(df, ["k"], ["t", "id"], ["id", "v"], "p", rows_per_segment=per)
    both = ordered.with_next(prev, ["k"], ["t", "id"], ["id"], "n", rows_per_segment=per)
    got = {r.id: (r.p and (r.p.id, r.p.v), r.n and r.n.id) for r in both.collect()}
    want = {}
    for g in groups(rows).values():
        for i, r in enumerate(g):
            want[r[2]] = ((g[i - 1][2], g[i - 1][3]) if i else None, g[i + 1][2] if i + 1 < len(g) else None)
    assert got == want


@pytest.mark.parametrize("per", [10, 10_000])
def test_last_known_and_running_sum(spark, rows, per):
    df = spark.createDataFrame(rows, "k string, t int, id int, v int").repartition(5)
    known = ordered.with_last_known(df, ["k"], ["t", "id"], "v", "l", rows_per_segment=per)
    out = ordered.with_running_sum(known, ["k"], ["t", "id"], "v", "s", rows_per_segment=per)
    got = {r.id: (r.l, r.s) for r in out.collect()}
    want = {}
    for g in groups(rows).values():
        last, total = None, None
        for r in g:
            if r[3] is not None:
                last, total = r[3], (total or 0) + r[3]
            want[r[2]] = (last, total)
    assert got == want


@pytest.mark.parametrize("per", [10, 10_000])
def test_without_keys(spark, rows, per):
    df = spark.createDataFrame(rows, "k string, t int, id int, v int").repartition(5)
    out = ordered.with_previous(df, [], ["t", "id"], ["id"], "p", rows_per_segment=per)
    got = {r.id: r.p and r.p.id for r in out.collect()}
    line = [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert got == {x: (line[i - 1] if i else None) for i, x in enumerate(line)}


def test_text_and_time_order(spark):
    words = [f"{a}{b}" for a in "zqéa" for b in "xyéa1"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    out = ordered.with_previous(df, [], ["w"], ["w"], "p", rows_per_segment=3)
    line = sorted(words, key=lambda w: w.encode())
    assert {r.w: r.p and r.p.w for r in out.collect()} == {x: (line[i - 1] if i else None) for i, x in enumerate(line)}
    times = spark.range(50).select(F.timestamp_seconds(F.col("id") * 977).alias("ts"), "id")
    out = ordered.with_previous(times, [], ["ts"], ["id"], "p", rows_per_segment=7)
    assert {r.id: r.p and r.p.id for r in out.collect()} == {i: (i - 1 if i else None) for i in range(50)}


def _quantile(xs, q):
    xs = sorted(xs)
    pos = q * (len(xs) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)


def test_exact_quantiles(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, id int, v int")
    out = quantiles.exact_quantiles(df, "t", {"a": 0.1, "m": 0.5, "z": 0.99}, ["k"])
    got = {r.k: (r.a, r.m, r.z) for r in out.collect()}
    by = groups(rows)
    for k, g in by.items():
        want = tuple(_quantile([r[1] for r in g], q) for q in (0.1, 0.5, 0.99))
        assert got[k] == pytest.approx(want)
    assert set(got) == set(by)
    (whole,) = quantiles.exact_quantiles(df, "t", {"m": 0.5}).collect()
    assert whole.m == pytest.approx(_quantile([r[1] for r in rows], 0.5))


def _doubles():
    rng = random.Random(8)
    plain = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(400)]
    near = [math.nextafter(2.0**e, to) for e in (-1000, -1, 0, 1, 52, 1000) for to in (0.0, math.inf)] + [2.0**e for e in range(-40, 40, 7)]
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308]
    return plain + near + [-x for x in near] + edges


def test_ordered_bits_order_like_doubles(spark):
    values = [*_doubles(), math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(x,) for x in values], "x double").select("x", quantiles.ordered_bits(F.col("x")).alias("b"))
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: (math.isnan(r[0]), 0 if math.isnan(r[0]) else r[0]))
    for (x, a), (y, b) in zip(got, got[1:], strict=False):
        assert (a == b) if x == y else (a < b), (x, y)


def test_quantiles_of_any_doubles(spark):
    values = _doubles()
    keyed = [(k, x) for k, part in (("a", values), (None, values[:7]), ("one", [3.5])) for x in part] + [("none", None)]
    df = spark.createDataFrame(keyed, "k string, x double")
    probs = {"low": 0.0, "a": 0.013, "m": 0.5, "z": 0.997, "high": 1.0}
    got = {r.k: r for r in quantiles.exact_quantiles(df, "x", probs, ["k"]).collect()}
    assert set(got) == {"a", None, "one"}, "a group without a value is left out"
    for k, part in (("a", values), (None, values[:7]), ("one", [3.5])):
        for name, q in probs.items():
            assert got[k][name] == _quantile(part, q), (k, name)
    odd = spark.createDataFrame([(math.inf,), (math.inf,), (1.0,), (math.nan,)], "x double")
    r = quantiles.exact_quantiles(odd, "x", {"low": 0.0, "m": 0.5, "high": 1.0}).first()
    assert r.low == 1.0 and r.m == math.inf and math.isnan(r.high)
    empty = quantiles.exact_quantiles(odd.limit(0), "x", {"m": 0.5}).collect()
    assert [e.m for e in empty] == [None]


def test_quantiles_read_nothing_while_they_are_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "no job may run")
    quantiles.exact_quantiles(spark.range(1000), "id", {"m": 0.5}, [])
    jobs = tracker.getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(jobs)


@pytest.mark.parametrize("per", [8, 10_000])
def test_as_of_forms_agree_with_brute_force(spark, per):
    rng = random.Random(3)
    versions = [(k, 10 * i, 10 * i + rng.choice([4, 8, 10]), i) for k in ("h", "x") for i in range(40)]
    requests = [(i, "h" if i % 3 else "x", rng.randint(-5, 420)) for i in range(200)] + [(900, "none", 5), (901, "h", None)]
    ts = lambda c: F.timestamp_seconds(F.col(c) * 3600).cast("timestamp_ntz").alias(c)
    v = spark.createDataFrame(versions, "k string, f int, t int, val int").select("k", ts("f"), ts("t"), "val")
    r = spark.createDataFrame(requests, "id int, k string, at int").select("id", "k", ts("at"))
    want = {
        i: next((val for (vk, f, t, val) in versions if at is not None and vk == k and f <= at < t), None)
        for i, k, at in requests
    }
    scan = asof.asof_join(r, v, ["k"], "at", "f", "t", ["val"], rows_per_segment=per)
    assert {x.id: x.val for x in scan.collect()} == want
    ranged = asof.asof_range_join(r, v, ["k"], ["id"], "at", "f", "t", ["val"])
    assert {x.id: x.val for x in ranged.collect()} == want
    full = asof.asof_or_latest(r, v, ["k"], "at", "f", "t", ["val"])
    got = {x.id: (x.val, x.match) for x in full.collect()}
    for i, k, _ in requests:
        if want[i] is not None:
            assert got[i] == (want[i], "as_of")
        else:
            assert got[i] == ((None, "none") if k == "none" else (39, "latest"))


def test_as_of_overlapping_ranges(spark):
    """An older version that is still open answers when the newer one has ended."""
    ts = lambda c: F.timestamp_seconds(F.col(c) * 86400).cast("timestamp_ntz").alias(c)
    v = spark.createDataFrame([("a", 0, 100, 1), ("a", 10, 20, 2), ("a", 5, None, 3)], "k string, f int, t int, val int")
    r = spark.createDataFrame([(1, "a", 15), (2, "a", 50), (3, "a", 3), (4, "a", 150)], "id int, k string, at int")
    out = asof.asof_range_join(
        r.select("id", "k", ts("at")), v.select("k", ts("f"), ts("t"), "val"), ["k"], ["id"], "at", "f", "t", ["val"]
    )
    assert {x.id: x.val for x in out.collect()} == {1: 2, 2: 3, 3: 1, 4: 3}


def test_dyadic_cells_cover_a_range_once(spark):
    rng = random.Random(4)
    spans = [(a, a + rng.choice([0, 1, 5, 100, 70_000, 200_000]) - rng.choice([0, 0, 2])) for a in (rng.randint(-90_000, 90_000) for _ in range(80))]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "id int, a bigint, b bigint")
    for r in df.withColumn("cells", asof.dyadic_cells(F.col("a"), F.col("b"))).collect():
        units = [u for c in r.cells for u in range(c.cell << c.level, (c.cell + 1) << c.level)]
        assert sorted(units) == list(range(r.a, r.b + 1))
        assert len(r.cells) <= 2 * max(r.b - r.a + 1, 1).bit_length() + 4
    ten_years = df.limit(1).select(asof.dyadic_cells(F.lit(8767), F.lit(8767 + 3652)).alias("c")).first().c
    assert len(ten_years) < 30


def test_as_of_range_join_meets_brute_force(spark):
    """Free validity: open for minutes or decades, before 1970, empty, inverted, without a start or an end; ties and NULLs."""
    rng = random.Random(9)
    day = 86_400
    versions = []
    for i in range(150):
        f = rng.randint(-3000 * day, 12_000 * day)
        t = rng.choice([f + rng.randint(-5, 600), f + rng.randint(0, 90 * day), f + rng.randint(0, 9000 * day), None, f])
        versions.append((rng.choice(["h", "h", "x", None]), None if i % 29 == 0 else f, t, i))
    requests = [(i, rng.choice(["h", "h", "x", "none", None]), None if i % 31 == 0 else rng.choice([rng.randint(-3100 * day, 12_100 * day), versions[i % 150][1]]))
                for i in range(300)]
    ts = lambda c: F.timestamp_seconds(F.col(c)).cast("timestamp_ntz").alias(c)
    v = spark.createDataFrame(versions, "k string, f bigint, t bigint, val int").select("k", ts("f"), ts("t"), "val")
    r = spark.createDataFrame(requests, "id int, k string, at bigint").select("id", "k", ts("at"))
    want = {}
    for i, k, at in requests:
        hits = [(f, val) for vk, f, t, val in versions if None not in (k, at, f) and vk == k and f <= at and (t is None or at < t)]
        want[i] = max(hits)[1] if hits else None
    for unit in ("day", "hour"):
        got = asof.asof_range_join(r, v, ["k"], ["id"], "at", "f", "t", ["val"], tie=["val"], unit=unit).collect()
        assert {x.id: x.val for x in got} == want and len(got) == len(requests)
    scan = asof.asof_join(r, v, ["k"], "at", "f", "t", ["val"], tie=["val"], rows_per_segment=40).collect()
    assert {x.id: x.val for x in scan} == want and len(scan) == len(requests)


@pytest.mark.parametrize("per", [5, 10_000])
def test_scd2_from_log(spark, per):
    log = [("a", i, "u", "x" if i < 20 else "y") for i in range(30)]
    log += [("b", 1, "c", "p"), ("b", 2, "d", "p"), ("b", 5, "c", "p"), ("b", 6, "u", "p"), ("b", 9, "u", "q")]
    df = spark.createDataFrame(log, "k string, ts int, op string, tier string")
    out = scd2.scd2_from_log(df, ["k"], ["tier"], ["ts"], "ts", rows_per_segment=per)
    got = {(r.k, r.tier, r.valid_from, r.valid_to) for r in out.collect()}
    assert got == {("a", "x", 0, 20), ("a", "y", 20, None), ("b", "p", 1, 2), ("b", "p", 5, 9), ("b", "q", 9, None)}


def _segments(df, keys, order, per):
    placed = ordered.place(df, keys, order, per)
    return sorted(r["count"] for r in placed.groupBy(ordered.SEGMENT).count().collect())


def _chain(df, order, per, name):
    out = ordered.with_previous(df, ["k"], order, [name], "p", rows_per_segment=per)
    return {r[name]: r.p and r.p[name] for r in out.collect()}


def test_a_burst_a_busy_day_and_a_common_prefix_are_cut(spark):
    """Whatever the order column holds, no segment is larger than asked for."""
    times = [i * 10_000_000 for i in range(30)] + [150_000_000 + i / 1000 for i in range(2000)]
    burst = spark.createDataFrame([("hot", float(t), i) for i, t in enumerate(times)], "k string, t double, id int")
    day = spark.range(2000).selectExpr("'h' as k", "date'2024-05-05' as t", "cast((id * 7919) % 2000 as int) as id")
    text = spark.range(2000).selectExpr("'h' as k", "concat('user-0000000', lpad(id, 5, '0')) as t", "cast(id as int) as id")
    line = [i for i, _ in sorted(enumerate(times), key=lambda x: x[1])]
    for df, order, want in (
        (burst, ["t", "id"], line), (day, ["t", "id"], list(range(2000))), (text, ["t"], list(range(2000))),
    ):
        sizes = _segments(df, ["k"], order, 200)
        assert sum(sizes) == len(want) and max(sizes) <= 200 and len(sizes) >= 10
        assert _chain(df, order, 200, "id") == {x: (want[i - 1] if i else None) for i, x in enumerate(want)}


def test_many_hot_groups_are_all_cut(spark):
    df = spark.range(4000).selectExpr("cast(id % 40 as string) as k", "id as t", "cast(id as int) as id")
    assert max(_segments(df, ["k"], ["t"], 40)) <= 40
    assert _chain(df, ["t"], 40, "id") == {i: (i - 40 if i >= 40 else None) for i in range(4000)}


def test_types_do_not_depend_on_the_size(spark):
    df = spark.range(300).selectExpr("id % 2 as k", "id as t", "cast(id as decimal(12,2)) as v")
    a, b = (ordered.with_running_sum(df, ["k"], ["t"], "v", "s", rows_per_segment=per) for per in (20, 10_000))
    assert a.schema["s"].dataType == b.schema["s"].dataType
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_as_of_finds_an_older_version_that_is_still_open(spark):
    rng = random.Random(9)
    versions = [(k, f := rng.randint(0, 300), f + rng.choice([1, 5, 40, 200, None or 900]), i) for i, k in enumerate("ab" * 40)]
    versions += [("a", 5, None, 900), ("b", 299, None, 901)]
    requests = [(i, rng.choice("abc"), rng.randint(-5, 420)) for i in range(150)]
    requests += requests[:20] + [(900, None, 5), (901, "a", None)]
    ts = lambda c: F.timestamp_seconds(F.col(c) * 36000).cast("timestamp_ntz").alias(c)
    v = spark.createDataFrame(versions, "k string, f int, t int, val int").select("k", ts("f"), ts("t"), "val")
    r = spark.createDataFrame(requests, "id int, k string, at int").select("id", "k", ts("at"))
    want = sorted(
        (i, max(((f, x) for vk, f, t, x in versions if at is not None and vk == k and f <= at and (t is None or t > at)), default=(0, -1))[1])
        for i, k, at in requests
    )
    for per in (20, 10_000):
        got = asof.asof_join(r, v, ["k"], "at", "f", "t", ["val"], tie=["val"], rows_per_segment=per).collect()
        assert sorted((x.id, -1 if x.val is None else x.val) for x in got) == want


@pytest.mark.parametrize("per,reach", [(6, 3), (9, 20), (40, 7), (10_000, 7)])
def test_trailing_frames_cross_segments(spark, per, reach):
    """Equal to the plain window, also where a frame spans several segments or a segment holds few rows of a key."""
    rng = random.Random(per)
    rows = [(k, t, rng.randrange(100)) for k, n in (("hot", 150), ("b", 9), (None, 30), ("one", 1)) for t in rng.sample(range(1000), n)]
    df = spark.createDataFrame(rows, "k string, t int, v int")

    def compute(frame, w):
        frame = frame.withColumn("was", F.lag("v", 1).over(w))
        near = w.rowsBetween(1 - reach, -1)
        return frame.withColumns({"n": F.count("v").over(near), "s": F.sum(F.col("v") - F.coalesce("was", F.lit(0))).over(near)})

    got = ordered.with_trailing(df, ["k"], ["t"], reach, compute, rows_per_segment=per)
    want = compute(df, Window.partitionBy("k").orderBy("t"))
    assert got.columns == want.columns
    key = lambda frame: sorted(map(str, frame.collect()))
    assert key(got) == key(want)
    whole = ordered.with_trailing(df.select("t", "v"), [], ["t", "v"], reach, compute, rows_per_segment=per)
    assert key(whole) == key(compute(df.select("t", "v"), Window.partitionBy().orderBy("t", "v")))


def test_spine_is_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(tables, "BLOCK", 7)
    day, stamp = dt.date, dt.datetime
    cases = [
        (day(2024, 1, 31), day(2024, 7, 1), "month", 1), (day(2020, 2, 29), day(2024, 2, 29), "year", 1), (day(2024, 1, 1), day(2024, 2, 1), "day", 3),
        (stamp(2024, 1, 1), stamp(2024, 1, 1, 3, 30), "minute", 5), (day(2024, 3, 1), day(2024, 2, 1), "day", 1), (day(2024, 3, 1), day(2024, 3, 1), "day", 1),
    ]
    for lo, hi, part, step in cases:
        bounds = spark.createDataFrame([(lo, hi)], "lo date, hi date" if type(lo) is day else "lo timestamp_ntz, hi timestamp_ntz")
        for inclusive in (False, True):
            want = [r[0] for r in bounds.where("lo <= hi").select(F.explode(F.sequence("lo", "hi", F.expr(f"interval {step} {part}")))).collect()]
            got = tables.date_spine(bounds, "lo", "hi", part, inclusive, "x", step)
            assert sorted(r.x for r in got.collect()) == [w for w in want if inclusive or w < hi], (lo, hi, part, inclusive)
    ten_years = spark.createDataFrame([(stamp(2014, 1, 1), stamp(2014, 1, 3))], "lo timestamp_ntz, hi timestamp_ntz")
    spine = tables.date_spine(ten_years, "lo", "hi", "second", name="x").select("x", F.spark_partition_id().alias("p"))
    counts = [r["count"] for r in spine.groupBy("p").count().collect()]
    assert sum(counts) == 2 * 86_400 and len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = spark.createDataFrame([(23,)], "top int")
    assert sorted(r[0] for r in tables.series_up_to(top, "top").collect()) == list(range(1, 24))
    assert tables.series_up_to(top.where("top < 0").agg(F.max("top").alias("top")), "top").count() == 0
