"""Generic table checks.

Every check takes a frame and returns its violations; an empty result passes. Conditions follow SQL:
a NULL comparison is not a violation unless a check says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.calendar import date_diff
from tallyframe.operators.ordered import ROWS_PER_SEGMENT, with_next, with_previous
from tallyframe.operators.setops import except_both_ways


def _count(df: DataFrame, group_by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(name))


def _paired_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of two frames side by side, 0 where a group is on one side only.

    One tagged union and one grouped count; NULL groups pair up like any other.
    """
    tag = a.select(*group_by, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*group_by, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return tag.groupBy(*group_by).agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("count_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("count_b")
    )


def accepted_range(df: DataFrame, column: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    c, bad = F.col(column), F.lit(False)
    if lo is not None:
        bad = bad | ~(c >= lo if inclusive else c > lo)
    if hi is not None:
        bad = bad | ~(c <= hi if inclusive else c < hi)
    return df.where(bad)


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole frame) without a single value."""
    return df.groupBy(*group_by).agg(F.count(column).alias("filled")).where("filled = 0")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs between two columns."""
    pairs = _paired_counts(
        df.select(F.col(column).alias("value_field")), to.select(F.col(field).alias("value_field")), ["value_field"]
    )
    return pairs.where("count_a <> count_b")


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose row counts differ; a group on one side only counts with all its rows."""
    return _paired_counts(a, b, group_by).withColumn(
        "diff_count", F.abs(F.col("count_a") - F.col("count_b"))
    ).where("diff_count > 0")


def equality(
    a: DataFrame,
    b: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] = (),
    precision: int | None = None,
    multiset: bool = False,
) -> DataFrame:
    """Rows found on one side only, labelled with the side."""
    cols = list(compare_columns) if compare_columns else [c for c in a.columns if c not in exclude_columns]

    def side(df: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
        return df.select(
            *[
                F.round(c, precision).alias(c)
                if precision is not None and kinds[c] in ("double", "float") else F.col(c)
                for c in cols
            ]
        )

    return except_both_ways(side(a), side(b), multiset)


def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None) -> DataFrame:
    """Rows where the expression is false; with ``column`` the expression continues its name."""
    if isinstance(expression, str):
        expression = F.expr(f"{column} {expression}" if column else expression)
    return df.where(~expression)


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups where ``a`` does not have fewer rows than ``b``."""
    delta = F.when(F.col("count_a") > F.col("count_b"), F.col("count_a") - F.col("count_b")).when(
        F.col("count_a") == F.col("count_b"), 1
    ).otherwise(0)
    return _paired_counts(a, b, group_by).withColumn("row_count_delta", delta).where("row_count_delta > 0")


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: Sequence[str] = (),
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Ranges that are inverted, overlap the next one, or break the rule on gaps."""
    nxt = with_next(df, partition_by, [lower, upper], [lower], "_next", rows_per_segment)
    lo, hi, after = F.col(lower), F.col(upper), F.col("_next")[lower]
    inner = lo <= hi if zero_length_range_allowed else lo < hi
    meets = {"allowed": hi <= after, "not_allowed": hi == after, "required": hi < after}[gaps]
    is_last = F.col("_next").isNull()
    ok = F.coalesce(inner, F.lit(False)) & F.coalesce(meets, is_last)
    return nxt.where(~ok).select(*df.columns, after.alias(f"next_{lower}"))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values))).select(column).distinct()


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups holding exactly one distinct value; min = max needs no list of values."""
    return (
        df.groupBy(*group_by)
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        .where("lo is not null and lo = hi")
        .select(*group_by, F.col("lo").alias("only_value"))
    )


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    c = F.trim(column) if trim_whitespace else F.col(column)
    return df.where(c == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    filled = F.avg(F.col(column).isNotNull().cast("double")).alias("not_null_proportion")
    return df.groupBy(*group_by).agg(filled).where(
        (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)
    )


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of: Column,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest time is older than ``as_of`` minus the interval."""
    cut = as_of - F.expr(f"interval {interval} {datepart}")
    newest = F.max(field)
    if ignore_time_component:
        cut, newest = F.to_date(cut), F.max(F.to_date(field))
    return df.groupBy(*group_by).agg(newest.alias("most_recent")).where(F.col("most_recent") < cut)


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | None = None,
    to_condition: str | None = None,
) -> DataFrame:
    """Child keys without a parent and their number of rows.

    Children are counted per key first, so a hot key is one row per task when it meets the parents.
    """
    child = df.where(from_condition) if from_condition else df
    parent = to.where(to_condition) if to_condition else to
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return keys.join(parent.select(F.col(field).alias("missing_key")), "missing_key", "left_anti")


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Rows that do not follow the row before by exactly one interval."""
    prev = with_previous(df, group_by, [column], [column], "_prev", rows_per_segment=rows_per_segment)
    before = F.col("_prev")[column]
    want = before + F.expr(f"interval {interval} {datepart}") if datepart else before + interval
    return prev.where(~(F.col(column) == want)).select(*df.columns, before.alias(f"previous_{column}"))


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _count(df, columns, "n_records").where("n_records > 1")


def missing_days(df: DataFrame, date_column: str) -> DataFrame:
    """One row with the number of days missing between the first and the last date, if any."""
    span = date_diff("day", F.min(date_column), F.max(date_column)) + 1
    return df.agg((span - F.count_distinct(F.to_date(date_column))).alias("missing_days")).where("missing_days > 0")
