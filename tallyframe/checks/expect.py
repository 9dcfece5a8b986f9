"""Expectation checks: violations per expectation, built on three kernels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyframe.functions.scalars import regexp_position
from tallyframe.operators.ordered import ROWS_PER_SEGMENT, with_previous, with_trailing
from tallyframe.operators.quantiles import exact_quantiles
from tallyframe.operators.tables import date_spine


def _rows(df: DataFrame, row_condition: str | None) -> DataFrame:
    return df.where(row_condition) if row_condition else df


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


# -- kernels ---------------------------------------------------------------------------------

def truth_expression(expression: str | Column, test_condition: str = "= true") -> Column:
    return F.expr(f"({expression}) {test_condition}") if isinstance(expression, str) else expression


def expression_is_true(
    df: DataFrame,
    expression: str | Column,
    group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    aggregate: bool = False,
    test_condition: str = "= true",
) -> DataFrame:
    """Rows, or groups when the expression is an aggregate, for which it is false. NULL passes."""
    src, truth = _rows(df, row_condition), truth_expression(expression, test_condition)
    if group_by or aggregate:
        return src.groupBy(*(group_by or [])).agg(truth.alias("expression")).where(~F.col("expression"))
    return src.where(~truth)


def _outside(value: Column, lo, hi, strictly: bool) -> Column:
    if lo is None and hi is None:
        raise ValueError("give a lower or an upper bound")
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (value > lo if strictly else value >= lo)
    if hi is not None:
        ok = ok & (value < hi if strictly else value <= hi)
    return ~ok


def expression_between(
    df: DataFrame,
    expression: str | Column,
    lo=None,
    hi=None,
    group_by: Sequence[str] = (),
    row_condition: str | None = None,
    strictly: bool = False,
) -> DataFrame:
    """Groups whose aggregate lies outside the bounds, with the measured value."""
    measured = _rows(df, row_condition).groupBy(*group_by).agg(_expr(expression).alias("measured"))
    return measured.where(_outside(F.col("measured"), lo, hi, strictly))


def equal_expression(
    a: DataFrame,
    expr_a: str | Column,
    b: DataFrame,
    expr_b: str | Column | None = None,
    group_by: Sequence[str] = (),
    compare_group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    compare_row_condition: str | None = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
    strict: bool = False,
) -> DataFrame:
    """Compare an aggregate of two frames, per group or as a whole.

    Groups meet in a full join. Two single values meet as a scalar subquery, not as a join. A missing side counts
    as 0, so a group on one side only is within tolerance or not like any other; ``strict`` lists it always.
    """
    expr_b = expr_a if expr_b is None else expr_b
    names = [f"col_{i + 1}" for i in range(len(group_by))]
    groups_b = list(compare_group_by or group_by)
    left = _rows(a, row_condition).groupBy(*[F.col(g).alias(n) for g, n in zip(group_by, names)]).agg(
        _expr(expr_a).alias("expression")
    )
    right = _rows(b, compare_row_condition).groupBy(
        *[F.col(g).alias(n) for g, n in zip(groups_b, names)]
    ).agg(_expr(expr_b).alias("compare_expression"))
    if names:
        r = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
        cond = reduce(lambda x, y: x & y, [left[n].eqNullSafe(r[f"_r_{n}"]) for n in names])
        joined = left.join(r, cond, "full").select(
            *[F.coalesce(n, f"_r_{n}").alias(n) for n in names], "expression", "compare_expression"
        )
    else:
        joined = left.withColumn("compare_expression", right.scalar())
    x, y = F.col("expression"), F.col("compare_expression")
    diff = F.abs(F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0)))
    out = joined.withColumns({
        "expression_difference": diff,
        "expression_difference_percent": F.try_divide(diff.cast("double"), F.nullif(x, F.lit(0)).cast("double")),
    })
    if tolerance_percent is not None:
        bad = F.col("expression_difference_percent") > tolerance_percent
    else:
        bad = F.col("expression_difference") > tolerance
    bad = F.coalesce(bad, F.lit(False))
    return out.where(bad | (x.isNull() != y.isNull()) if strict else bad)


def ignore_row_if(columns: Sequence[str], mode: str = "all_values_are_missing") -> Column:
    """Rows to keep before a uniqueness check."""
    op = {"all_values_are_missing": lambda x, y: x & y, "any_value_is_missing": lambda x, y: x | y}[mode]
    return ~reduce(op, [F.col(c).isNull() for c in columns])


# -- recency and shape -------------------------------------------------------------------------

def recent_data(
    df: DataFrame, column: str, datepart: str, interval: int, as_of: Column, row_condition: str | None = None
) -> DataFrame:
    """Newest time not in the future, when too old; an empty frame counts as 1970-01-01."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    newest = _rows(df, row_condition).where(F.col(column) <= as_of).agg(
        F.coalesce(F.max(column).cast("timestamp_ntz"), epoch).alias("most_recent")
    )
    return newest.where(F.col("most_recent") < as_of - F.expr(f"interval {interval} {datepart}"))


def grouped_recent_data(
    df: DataFrame,
    group_by: Sequence[str],
    column: str,
    datepart: str,
    interval: int,
    as_of: Column,
    row_condition: str | None = None,
) -> DataFrame:
    newest = _rows(df, row_condition).where(F.col(column) <= as_of).groupBy(*group_by).agg(
        F.max(column).alias("most_recent")
    )
    return newest.where(F.col("most_recent") < as_of - F.expr(f"interval {interval} {datepart}"))


def aggregation_equal(a, expression, b, compare_expression=None, **kw) -> DataFrame:
    return equal_expression(a, expression, b, compare_expression, **kw)


def row_count_between(df, lo=None, hi=None, group_by=(), row_condition=None, strictly=False) -> DataFrame:
    return expression_between(df, F.count(F.lit(1)), lo, hi, group_by, row_condition, strictly)


def row_count_equal(df, value, group_by=(), row_condition=None) -> DataFrame:
    return expression_between(df, F.count(F.lit(1)), value, value, group_by, row_condition)


def row_count_equal_other(a, b, group_by=(), compare_group_by=None, factor=1, **kw) -> DataFrame:
    return equal_expression(
        a, F.count(F.lit(1)), b, F.count(F.lit(1)) * factor,
        group_by=group_by, compare_group_by=compare_group_by, **kw,
    )


def row_count_times_factor(a, b, factor, **kw) -> DataFrame:
    return row_count_equal_other(a, b, factor=factor, **kw)


# -- column values ------------------------------------------------------------------------------

def values_between(df, column, lo=None, hi=None, row_condition=None, strictly=False) -> DataFrame:
    return _rows(df, row_condition).where(_outside(F.col(column), lo, hi, strictly))


def values_in_set(df, column, values: Sequence | DataFrame, row_condition=None) -> DataFrame:
    """Rows outside the set. A NULL value is a violation here.

    A set given as a one-column frame may be large: it joins instead of becoming a literal list.
    """
    src = _rows(df, row_condition)
    if isinstance(values, DataFrame):
        members = values.select(F.col(values.columns[0]).alias("_member")).distinct()
        return src.join(members, F.col(column) == F.col("_member"), "left_anti")
    return src.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def values_not_in_set(df, column, values: Sequence | DataFrame, row_condition=None) -> DataFrame:
    src = _rows(df, row_condition)
    if isinstance(values, DataFrame):
        members = values.select(F.col(values.columns[0]).alias("_member")).distinct()
        return src.join(members, F.col(column) == F.col("_member"), "left_semi")
    return src.where(F.col(column).isin(list(values)))


def values_null(df, column, row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(F.col(column).isNotNull())


def values_not_null(df, column, row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(F.col(column).isNull())


def _monotone(df, column, sort_columns, strictly, row_condition, group_by, up, rows_per_segment) -> DataFrame:
    src = _rows(df, row_condition)
    order = list(sort_columns or [column])
    prev = with_previous(src, group_by, order, [column], "_prev", rows_per_segment=rows_per_segment)
    x, y = F.col(column), F.col("_prev")[column]
    if up:
        ok = x > y if strictly else x >= y
    else:
        ok = x < y if strictly else x <= y
    return prev.where(~ok).select(*df.columns, y.alias("value_lag"))


def values_increasing(
    df, column, sort_columns=None, strictly=True, row_condition=None, group_by=(), rows_per_segment=ROWS_PER_SEGMENT
) -> DataFrame:
    """Rows whose value is not above (or at) the value before, in sort order."""
    return _monotone(df, column, sort_columns, strictly, row_condition, group_by, True, rows_per_segment)


def values_decreasing(
    df, column, sort_columns=None, strictly=True, row_condition=None, group_by=(), rows_per_segment=ROWS_PER_SEGMENT
) -> DataFrame:
    return _monotone(df, column, sort_columns, strictly, row_condition, group_by, False, rows_per_segment)


def consistent_casing(df, column, display: bool = False) -> DataFrame:
    """Values that differ only in letter case: a row per group of them, or with ``display`` a row per value."""
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    groups = (
        values.groupBy(F.lower(column).alias("lower_value"))
        .agg(F.count(F.lit(1)).alias("n_variants"))
        .where("n_variants > 1")
    )
    if not display:
        return groups
    named = values.withColumn("lower_value", F.lower(column))
    return named.join(groups.select("lower_value"), "lower_value", "left_semi").select("lower_value", column, "n_rows")


# -- several columns ----------------------------------------------------------------------------

def a_greater_than_b(df, a, b, or_equal=False, row_condition=None) -> DataFrame:
    ok = F.col(a) >= F.col(b) if or_equal else F.col(a) > F.col(b)
    return _rows(df, row_condition).where(~ok)


def pair_equal(df, a, b, row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(~(F.col(a) == F.col(b)))


def pair_in_set(df, a, b, pairs: Sequence[tuple], row_condition=None) -> DataFrame:
    hit = reduce(lambda x, y: x | y, [(F.col(a) == p) & (F.col(b) == q) for p, q in pairs])
    return _rows(df, row_condition).where(~hit)


def compound_unique(df, columns, ignore="all_values_are_missing", row_condition=None) -> DataFrame:
    return (
        _rows(df, row_condition)
        .where(ignore_row_if(columns, ignore))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def unique(df, column, row_condition=None) -> DataFrame:
    return compound_unique(df, [column], row_condition=row_condition)


def multicolumn_sum(df, columns, total: str | Column | float, group_by=(), row_condition=None) -> DataFrame:
    """Groups where the column sums do not add up to ``total`` (a number or an aggregate)."""
    summed = reduce(lambda x, y: x + y, [F.sum(c) for c in columns])
    want = _expr(total) if isinstance(total, (str, Column)) else F.lit(total)
    out = _rows(df, row_condition).groupBy(*group_by).agg(summed.alias("measured"), want.alias("expected"))
    return out.where(F.col("measured") != F.col("expected"))


def unique_within_record(df, columns, ignore="all_values_are_missing", row_condition=None) -> DataFrame:
    """Rows that repeat a value across columns; decided inside the row, without a shuffle."""
    texts = F.array(*[F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) for c in columns])
    return _rows(df, row_condition).where(ignore_row_if(columns, ignore)).where(
        F.size(F.array_distinct(texts)) < len(columns)
    )


# -- aggregates -----------------------------------------------------------------------------------

def _aggregate_between(build: Callable[[str], Column]):
    def check(df, column, lo=None, hi=None, group_by=(), row_condition=None, strictly=False) -> DataFrame:
        return expression_between(df, build(column), lo, hi, group_by, row_condition, strictly)

    return check


max_between = _aggregate_between(F.max)
min_between = _aggregate_between(F.min)
mean_between = _aggregate_between(F.avg)
sum_between = _aggregate_between(F.sum)
stdev_between = _aggregate_between(F.stddev_samp)
unique_value_count_between = _aggregate_between(F.count_distinct)
unique_proportion_between = _aggregate_between(
    lambda c: F.try_divide(F.count_distinct(c).cast("double"), F.count(c))
)


def quantile_between(df, column, quantile, lo=None, hi=None, group_by=(), row_condition=None, strictly=False) -> DataFrame:
    """Exact quantile per group, computed from value counts."""
    measured = exact_quantiles(_rows(df, row_condition), column, {"measured": quantile}, group_by)
    return measured.where(_outside(F.col("measured"), lo, hi, strictly))


def median_between(df, column, lo=None, hi=None, group_by=(), row_condition=None, strictly=False) -> DataFrame:
    return quantile_between(df, column, 0.5, lo, hi, group_by, row_condition, strictly)


def distinct_count_greater(df, column, value, group_by=(), row_condition=None) -> DataFrame:
    return expression_between(df, F.count_distinct(column), value, None, group_by, row_condition, True)


def distinct_count_less(df, column, value, group_by=(), row_condition=None) -> DataFrame:
    return expression_between(df, F.count_distinct(column), None, value, group_by, row_condition, True)


def distinct_count_equal(df, column, value, group_by=(), row_condition=None) -> DataFrame:
    return expression_between(df, F.count_distinct(column), value, value, group_by, row_condition)


def distinct_count_equal_other(a, column, b, other, **kw) -> DataFrame:
    return equal_expression(a, F.count_distinct(column), b, F.count_distinct(other), **kw)


def _distinct(df, column, row_condition) -> DataFrame:
    return _rows(df, row_condition).select(F.col(column).alias("value_field")).distinct()


def _set_frame(df: DataFrame, values: Sequence) -> DataFrame:
    """The value list as a frame, in the session of ``df``."""
    return df.sparkSession.createDataFrame([(v,) for v in values], ["value_field"])


def distinct_values_in_set(df, column, values, row_condition=None) -> DataFrame:
    return values_in_set(_distinct(df, column, row_condition), "value_field", values)


def distinct_values_contain_set(df, column, values, row_condition=None) -> DataFrame:
    seen = _rows(df, row_condition).where(F.col(column).isin(list(values)))
    return _set_frame(df, values).join(_distinct(seen, column, None), "value_field", "left_anti")


def distinct_values_equal_set(df, column, values, row_condition=None) -> DataFrame:
    """Values on one side only, with the side."""
    extra = distinct_values_in_set(df, column, values, row_condition)
    missing = distinct_values_contain_set(df, column, values, row_condition)
    return extra.select("value_field", F.lit("not_in_set").alias("side")).unionByName(
        missing.select("value_field", F.lit("not_in_column").alias("side"))
    )


def most_common_in_set(df, column, values, top_n=1, row_condition=None) -> DataFrame:
    """The value at frequency rank ``top_n``, when outside the set; ties go by value."""
    counts = _rows(df, row_condition).groupBy(F.col(column).alias("value_field")).agg(
        F.count(F.lit(1)).alias("value_count")
    )
    top = counts.orderBy(F.desc("value_count"), "value_field").limit(top_n)
    ranked = top.withColumn(
        "value_count_rank", F.row_number().over(Window.orderBy(F.desc("value_count"), "value_field"))
    )
    return values_in_set(ranked.where(F.col("value_count_rank") == top_n), "value_field", values)


# -- text --------------------------------------------------------------------------------------------

def length_between(df, column, lo=None, hi=None, row_condition=None, strictly=False) -> DataFrame:
    return _rows(df, row_condition).where(_outside(F.length(column), lo, hi, strictly))


def length_equal(df, column, value, row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(F.length(column) != value)


def _combined(tests: Sequence[Column], match_on: str) -> Column:
    op = {"any": lambda x, y: x | y, "all": lambda x, y: x & y}[match_on]
    return reduce(op, tests)


def _matches(column: str, pattern: str, flags: str) -> Column:
    return regexp_position(F.col(column), pattern, flags=flags) > 0


def match_regex(df, column, regex, row_condition=None, flags="") -> DataFrame:
    return _rows(df, row_condition).where(~_matches(column, regex, flags))


def not_match_regex(df, column, regex, row_condition=None, flags="") -> DataFrame:
    return _rows(df, row_condition).where(_matches(column, regex, flags))


def match_regex_list(df, column, regexes, match_on="any", row_condition=None, flags="") -> DataFrame:
    return _rows(df, row_condition).where(~_combined([_matches(column, r, flags) for r in regexes], match_on))


def not_match_regex_list(df, column, regexes, match_on="any", row_condition=None, flags="") -> DataFrame:
    """With ``any`` a row passes as soon as one pattern is absent."""
    return _rows(df, row_condition).where(~_combined([~_matches(column, r, flags) for r in regexes], match_on))


def match_like(df, column, pattern, row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(~F.col(column).like(pattern))


def not_match_like(df, column, pattern, row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(F.col(column).like(pattern))


def match_like_list(df, column, patterns, match_on="any", row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(~_combined([F.col(column).like(p) for p in patterns], match_on))


def not_match_like_list(df, column, patterns, match_on="any", row_condition=None) -> DataFrame:
    return _rows(df, row_condition).where(~_combined([~F.col(column).like(p) for p in patterns], match_on))


# -- distribution ---------------------------------------------------------------------------------------

def within_n_stdevs(df, column, group_by: Sequence[str], sigma_threshold: float = 3) -> DataFrame:
    """Groups whose sum lies more than n standard deviations from the mean of all groups.

    Mean and deviation come from a one-row subquery; no window over the whole frame.
    """
    sums = df.groupBy(*group_by).agg(F.sum(F.col(column).cast("double")).alias("metric_value"))
    s = sums.agg(
        F.struct(F.avg("metric_value").alias("avg"), F.stddev_samp("metric_value").alias("sd")).alias("s")
    ).scalar()
    sigma = F.try_divide(F.col("metric_value") - s["avg"], F.nullif(s["sd"], F.lit(0.0)))
    return sums.withColumn("sigma", sigma).where(F.abs("sigma") > sigma_threshold)


def _log_metric(name: str, take_logs: bool) -> Column:
    return F.coalesce(F.ln(F.nullif(F.col(name), F.lit(0.0))), F.lit(0.0)) if take_logs else F.coalesce(
        F.col(name), F.lit(0.0)
    )


def within_n_moving_stdevs(
    df,
    column,
    date_column,
    as_of: Column,
    group_by: Sequence[str] = (),
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_upper: float | None = None,
    sigma_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Periods whose (log) change leaves the band of the periods before them.

    Rows are summed per period before the shuffle. The change and its band come from one trailing frame over the summed
    periods, which crosses segments, so a group (or a table without groups) of any number of periods is cut.
    """
    upper = sigma_threshold if sigma_upper is None else sigma_upper
    lower = -sigma_threshold if sigma_lower is None else sigma_lower
    periods = df.groupBy(F.date_trunc(period, date_column).alias("metric_period"), *group_by).agg(
        F.sum(F.col(column).cast("double")).alias("_total")
    )
    reach = trend_periods + (lookback_periods if take_diffs else 0)

    def band(rows: DataFrame, w: WindowSpec) -> DataFrame:
        change = _log_metric("_total", take_logs)
        if take_diffs:
            rows = rows.withColumn("_before", F.lag("_total", lookback_periods).over(w))
            change = change - _log_metric("_before", take_logs)
        frame = w.rowsBetween(-trend_periods, -1)
        return rows.withColumn("_change", change).withColumn(
            "_sigma", F.try_divide(
                F.col("_change") - F.avg("_change").over(frame), F.nullif(F.stddev_samp("_change").over(frame), F.lit(0.0))
            )
        )

    now = F.date_trunc(period, as_of)
    tested = (F.col("metric_period") >= now - F.expr(f"interval {test_periods} {period}")) & (F.col("metric_period") < now)
    banded = with_trailing(periods, group_by, ["metric_period"], reach, band, rows_per_segment)
    # the result column of the check has a fixed name
    return banded.where(tested & ~((F.col("_sigma") >= lower) & (F.col("_sigma") <= upper))).select(
        "metric_period", *group_by, F.col("_total").alias("agg_metric_value"), F.col("_sigma").alias("metric_test_sigma")
    )


def data_every_n_datepart(
    df,
    date_column,
    date_part: str = "day",
    interval: int = 1,
    row_condition=None,
    exclusion_condition: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Slots of the calendar without rows. The end is excluded unless ``inclusive``.

    The spine has one row per slot between two dates, is filled by many tasks and is joined to counts per slot.
    """
    src = _rows(df, row_condition)
    lo = F.date_trunc(date_part, F.min(date_column) if start is None else start)
    hi = F.date_trunc(date_part, F.max(date_column) if end is None else end)
    bounds = src.agg(lo.alias("_lo"), hi.alias("_hi"))
    spine = date_spine(bounds, "_lo", "_hi", date_part, inclusive, "date_slot", interval)
    first = src.agg(F.date_trunc(date_part, F.min(date_column)).alias("m")).scalar() if start is None else F.date_trunc(date_part, start)
    bucket = F.date_trunc(date_part, date_column)
    if interval > 1:
        unit = F.timestamp_diff(date_part.upper(), first, bucket)
        bucket = F.timestamp_add(date_part.upper(), unit - F.pmod(unit, F.lit(interval)), first)
    counts = src.groupBy(bucket.alias("date_slot")).agg(F.count(F.lit(1)).alias("row_cnt"))
    gaps = spine.join(counts, "date_slot", "left").select(
        "date_slot", F.coalesce("row_cnt", F.lit(0)).alias("row_cnt")
    ).where("row_cnt = 0")
    return gaps.where(exclusion_condition) if exclusion_condition else gaps
