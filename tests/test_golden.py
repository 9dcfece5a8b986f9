"""Golden cases of the table utilities, calendar helpers and checks, re-typed as inline frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.checks import contracts, expect, generic
from tallyframe.functions import calendar as C
from tallyframe.functions import scalars as S
from tallyframe.operators import calendar_tables, setops, tables
from tallyframe.operators.latest import deduplicate


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def values(df):
    return [r[0] for r in df.collect()]


# -- table utilities ---------------------------------------------------------------------------------


def test_deduplicate_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, None, 1)], "user_id int, event string, version int")
    out = deduplicate(df, ["user_id", "event"], [F.desc("version")])
    assert rows(out) == [(1, "play", 2), (2, None, 1)]


def test_union_superset(spark):
    a = spark.createDataFrame([(1, "bob", 3)], "id int, name string, favorite_number int")
    b = spark.createDataFrame([(2, "green", 7)], "id int, favorite_color string, favorite_number int")
    out = tables.union_relations({"a": a, "b": b}, where="id > 0")
    assert out.columns == ["source_name", "id", "name", "favorite_number", "favorite_color"]
    assert rows(out) == [("a", 1, "bob", 3, None), ("b", 2, None, 7, "green")]
    narrow = tables.union_relations({"a": a, "b": b}, exclude=["favorite_number"], source_column=None,
                                    column_override={"id": "string"})
    assert narrow.dtypes == [("id", "string"), ("name", "string"), ("favorite_color", "string")]


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    assert rows(tables.pivot(df, ["size"], "color", ["red", "blue", "blue's"])) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    people = spark.createDataFrame([(123, "active", True), (567, "churned", None)], "customer_id int, status string, is_updated boolean")
    assert rows(tables.unpivot(people, ["customer_id"], field_name="prop", value_name="val")) == [
        (123, "is_updated", "true"), (123, "status", "active"), (567, "is_updated", None), (567, "status", "churned"),
    ]


def test_surrogate_key(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "c1 string, c2 string, c3 string"
    )
    got = [tuple(r) for r in df.select(tables.surrogate_key(["c1"]), tables.surrogate_key(["c1", "c2", "c3"])).collect()]
    assert got == [
        ("0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert values(df.select(tables.width_bucket(F.col("a"), 200000, 600000, 4))) == [0, 1, 2, 2, 3, 3, 4, 5]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert values(df.select(tables.safe_add(["a", "b", "c"]))) == [6, 4, 2, 0]
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert values(df.select(tables.safe_subtract(["a", "b", "c"]))) == [0, 1, -2, 0]
    df = spark.createDataFrame([(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (0, 5)], "n int, d int")
    assert values(df.select(tables.safe_divide(F.col("n"), F.col("d")))) == [None, 2.0, None, None, None, None, 0.0]


def test_haversine(spark):
    at = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    (r,) = spark.range(1).select(
        F.round(tables.haversine(*at, "km"), 0).alias("km"), F.round(tables.haversine(*at), 0).alias("mi")
    ).collect()
    assert (r.km, r.mi) == (430, 267)


def test_urls(spark):
    q = "www.search.example?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer"
    hosts = {
        q: "www.search.example",
        "http://blog.example.com/2018/01/how-to-run/": "blog.example.com",
        "https://www.news.example/2018/01/01/blog": "www.news.example",
        "android-app://m.social.example/": "m.social.example",
        "docs.news.example/2021/01/01/index.js?utm_source=google": "docs.news.example",
        "https://m.social.example/": "m.social.example",
    }
    df = spark.createDataFrame([(u,) for u in hosts], "u string")
    assert values(df.select(tables.url_host(F.col("u")))) == list(hosts.values())
    paths = {
        q: "", "https://www.news.example/2018/01/01/blog": "2018/01/01/blog",
        "http://blog.example.com/2018/01/tips/?utm_source=google&utm_medium=cpc": "2018/01/tips/",
    }
    df = spark.createDataFrame([(u,) for u in paths], "u string")
    assert values(df.select(tables.url_path(F.col("u")))) == list(paths.values())
    df = spark.createDataFrame(
        [("http://shop.example.org/milk?utm_medium=organic",), ("http://shop.example.org/milk?utm_medium=organic&utm_source=github",)],
        "u string",
    )
    got = [tuple(r) for r in df.select(
        tables.url_parameter(F.col("u"), "utm_medium"), tables.url_parameter(F.col("u"), "utm_source")).collect()]
    assert got == [("organic", None), ("organic", "github")]


def test_date_spine_excludes_its_end(spark):
    b = spark.sql("select date'2018-01-01' lo, date'2018-01-10' hi")
    days = [r.date_day for r in tables.date_spine(b, "lo", "hi").collect()]
    assert days == [dt.date(2018, 1, d) for d in range(1, 10)]
    assert tables.date_spine(b, "lo", "hi", inclusive=True).count() == 10
    assert values(tables.generate_series(spark, 4)) == [1, 2, 3, 4]


def test_nullcheck_star_and_single_value(spark):
    df = spark.createDataFrame([("", "x", 1), ("a", "", 2)], "f1 string, f2 string, n int")
    assert rows(tables.nullcheck(df)) == [("a", None, 2), (None, "x", 1)]
    assert tables.star(df, ["N"], prefix="p_").columns == ["p_f1", "p_f2"]
    assert values(df.limit(1).select(tables.single_value(df.where("n > 5"), F.max("n"), -1))) == [-1]


# -- calendar -----------------------------------------------------------------------------------------


def test_calendar_golden_days(spark):
    df = spark.createDataFrame([(dt.date(2020, 11, 29),), (dt.date(2020, 12, 1),)], "d date")
    d = F.col("d")
    got = [tuple(r) for r in df.select(
        C.yesterday(d), C.tomorrow(d), C.day_name(d, False), C.day_name(d), C.day_of_week(d, False), C.day_of_week(d),
        F.dayofyear(d), C.week_start(d), C.week_end(d), C.week_of_year(d), C.iso_week_start(d), C.iso_week_end(d),
        C.iso_week_of_year(d), F.month(d), C.month_name(d, False), C.month_name(d),
    ).collect()]
    D = dt.date
    assert got == [
        (D(2020, 11, 28), D(2020, 11, 30), "Sunday", "Sun", 1, 7, 334, D(2020, 11, 29), D(2020, 12, 5), 48,
         D(2020, 11, 23), D(2020, 11, 29), 48, 11, "November", "Nov"),
        (D(2020, 11, 30), D(2020, 12, 2), "Tuesday", "Tue", 3, 2, 336, D(2020, 11, 29), D(2020, 12, 5), 48,
         D(2020, 11, 30), D(2020, 12, 6), 49, 12, "December", "Dec"),
    ]


def test_epoch_rounding_and_zone(spark):
    ts = F.lit("2021-06-07 14:35:20").cast("timestamp_ntz")
    (r,) = spark.range(1).select(
        C.to_unixtimestamp(ts).alias("e"),
        C.from_unixtimestamp(F.lit(1623076520)).cast("timestamp_ntz").alias("t"),
        C.round_timestamp(ts).cast("timestamp_ntz").alias("r"),
        C.convert_timezone(ts, "America/Los_Angeles").alias("z"),
    ).collect()
    assert r.e == 1623076520 and r.t == dt.datetime(2021, 6, 7, 14, 35, 20)
    assert r.r == dt.datetime(2021, 6, 8) and r.z == dt.datetime(2021, 6, 7, 7, 35, 20)


def test_date_diff_counts_boundaries(spark):
    a, b = F.lit("2024-01-31 23:59:59").cast("timestamp_ntz"), F.lit("2024-02-01 00:00:01").cast("timestamp_ntz")
    (r,) = spark.range(1).select(*[C.date_diff(u, a, b).alias(u) for u in ("year", "month", "day", "hour", "minute", "second")]).collect()
    assert r.asDict() == {"year": 0, "month": 1, "day": 1, "hour": 1, "minute": 1, "second": 2}


def test_fiscal_calendar_covers_days_once(spark):
    b = spark.sql("select date'2015-01-01' lo, date'2022-12-31' hi")
    dim = calendar_tables.date_dimension(tables.date_spine(b, "lo", "hi"))
    assert len(dim.columns) == 36
    out = calendar_tables.fiscal_periods(dim, year_end_month=1).collect()
    days = [r.date_day for r in out]
    assert len(days) == len(set(days))
    per_year = {}
    for r in out:
        per_year.setdefault(r.fiscal_year_number, set()).add(r.fiscal_week_of_year)
    assert all(max(w) in (52, 53) and len(w) == max(w) for y, w in per_year.items())
    assert {r.fiscal_period_number for r in out} == set(range(1, 13))


# -- checks ------------------------------------------------------------------------------------------------


def test_exclusive_ranges(spark):
    df = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert generic.mutually_exclusive_ranges(df, "lo", "hi", gaps="not_allowed").count() == 0
    assert generic.mutually_exclusive_ranges(df, "lo", "hi", gaps="required").count() == 2
    zero = spark.createDataFrame([(3, 1, 2), (3, 3, 5), (3, 3, 3), (3, 7, 9)], "s int, lo int, hi int")
    assert generic.mutually_exclusive_ranges(zero, "lo", "hi", ["s"], zero_length_range_allowed=True).count() == 0
    assert generic.mutually_exclusive_ranges(zero, "lo", "hi", ["s"]).count() == 1
    over = spark.createDataFrame([(0, 5), (3, 8)], "lo int, hi int")
    assert rows(generic.mutually_exclusive_ranges(over, "lo", "hi")) == [(0, 5, 3)]


def test_null_rules(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "x int")
    assert values(generic.accepted_range(df, "x", 0, 5)) == [9]
    assert values(expect.values_between(df, "x", 0, 5)) == [9]
    assert sorted(values(expect.values_in_set(df, "x", [1])), key=str) == [9, None]
    assert values(expect.values_not_in_set(df, "x", [9])) == [9]
    assert generic.expression_is_true(df, "x < 100").count() == 0
    assert values(generic.relationships_where(df, "x", df.where("x = 1"), "x").select("missing_key")) == [9]


def test_row_counts_and_groups(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "g string")
    b = spark.createDataFrame([("x",), ("z",)], "g string")
    assert rows(generic.equal_rowcount(a, b, ["g"])) == [("x", 2, 1, 1), ("y", 1, 0, 1), ("z", 0, 1, 1)]
    assert generic.equal_rowcount(a, a).count() == 0
    assert rows(generic.fewer_rows_than(b, a)) == []
    assert rows(generic.fewer_rows_than(a, a)) == [(3, 3, 1)]
    assert rows(generic.at_least_one(spark.createDataFrame([("a", None), ("b", 1)], "g string, v int"), "v", ["g"])) == [("a", 0)]


def test_equality(spark):
    a = spark.createDataFrame([(1, 1.001), (2, 5.0), (2, 5.0)], "id int, x double")
    b = spark.createDataFrame([(1, 1.002), (2, 5.0)], "id int, x double")
    assert generic.equality(a, b, precision=2).count() == 0
    assert generic.equality(a, b, precision=3).count() == 2
    assert rows(generic.equality(a, b, ["id"], multiset=True)) == [("a_minus_b", 2, 1)]
    assert rows(setops.except_both_ways(a.select("id"), b.select("id"))) == []


def test_expectations_on_the_small_frame(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 1.0, "a", "b", None), (2, 1.0, 0.0, "b", "ab", None), (3, 0.5, 0.5, "c", "abc", None), (4, 0.5, 0.5, "c", "abcd", None)],
        "idx int, na double, nb double, sa string, sb string, nothing string",
    )
    passing = [
        expect.unique(df, "idx"), expect.values_null(df, "nothing"), expect.values_increasing(df, "idx"),
        expect.values_between(df, "na", 0, 1), expect.multicolumn_sum(df, ["na", "nb"], 4),
        expect.distinct_values_equal_set(df, "sa", ["a", "b", "c"]), expect.most_common_in_set(df, "sa", ["c"]),
        expect.length_between(df, "sb", 1, 4), expect.compound_unique(df, ["sa", "sb"]),
        expect.distinct_count_equal(df, "sa", 3), expect.median_between(df, "na", 0.5, 0.5),
        expect.unique_proportion_between(df, "na", 0.75, 0.75), expect.expression_is_true(df, "na + nb = 1"),
        expect.pair_in_set(df, "na", "nb", [(0.0, 1.0), (1.0, 0.0), (0.5, 0.5)]),
        expect.row_count_equal(df, 4), expect.row_count_equal_other(df, df), expect.match_regex(df, "sb", "^[a-d]+$"),
        expect.within_n_stdevs(df, "na", ["sa"], 3), expect.values_decreasing(df, "nb", ["idx"], strictly=False, row_condition="idx < 3"),
    ]
    assert [i for i, f in enumerate(passing) if f.count()] == []
    failing = {
        "casing": expect.consistent_casing(spark.createDataFrame([("A",), ("a",)], "s string"), "s"),
        "record": expect.unique_within_record(df, ["na", "nb"]),
        "increasing": expect.values_increasing(df, "na", ["idx"]),
        "like": expect.match_like_list(df, "sb", ["%d%", "b%"]),
        "regex_any": expect.not_match_regex_list(df, "sb", ["a", "b"], "all"),
        "tolerance": expect.equal_expression(df, F.sum("na"), df, F.sum("idx"), tolerance=1.0),
    }
    assert {k: f.count() for k, f in failing.items()} == {
        "casing": 1, "record": 2, "increasing": 2, "like": 2, "regex_any": 4, "tolerance": 1,
    }


def test_recent_data_of_an_empty_frame_fails(spark):
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    empty = spark.createDataFrame([], "t timestamp_ntz")
    assert expect.recent_data(empty, "t", "day", 1, now).count() == 1


def test_gaps_with_and_without_the_last_slot(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 4, 5)], "d date")
    assert [r.date_slot.day for r in expect.data_every_n_datepart(df, "d").collect()] == [3]
    assert expect.data_every_n_datepart(df, "d", interval=2).count() == 0
    later = expect.data_every_n_datepart(df, "d", end=F.lit(dt.date(2024, 1, 7)), inclusive=True)
    assert sorted(r.date_slot.day for r in later.collect()) == [3, 6, 7]


def test_moving_stdevs_find_a_jump(spark):
    rows_ = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + i % 3 + (900 if i == 25 else 0)) for i in range(30)]
    df = spark.createDataFrame(rows_, "d date, v double")
    out = expect.within_n_moving_stdevs(df, "v", "d", F.lit("2024-01-31").cast("timestamp_ntz"))
    assert dt.datetime(2024, 1, 26) in [r.metric_period.replace(tzinfo=None) for r in out.collect()]


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id bigint, name string")
    out = contracts.schema_contract(df, [("id", "int", False), ("name", "string", False), ("age", "int", True)])
    assert rows(out) == [
        ("column_exists", "age", "present", "missing", 0), ("column_type", "id", "int", "bigint", 0),
        ("not_null", "name", "no NULL", "NULL", 1),
    ]


@pytest.mark.parametrize("pos,occ,want", [(1, 1, 3), (4, 1, 5), (1, 2, 5), (1, 3, 0)])
def test_regexp_position(spark, pos, occ, want):
    df = spark.createDataFrame([("ab1c2",)], "s string")
    assert values(df.select(S.regexp_position(F.col("s"), "[0-9]", pos, occ))) == [want]


def test_dirty_text(spark):
    df = spark.createDataFrame([("12.345", "2024-01-02T03:04:05Z", "19724"), ("bad", "nope", "2024-01-02")], "a string, t string, d string")
    got = [tuple(r) for r in df.select(
        S.decimal_of(F.col("a"), 2).cast("string"), S.best_effort_ts(F.col("t")).cast("timestamp_ntz"), S.text_or_days_to_date(F.col("d"))
    ).collect()]
    assert got == [("12.35", dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2)), (None, None, dt.date(2024, 1, 2))]
