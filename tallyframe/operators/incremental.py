"""Incremental slices of a mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incremental_slice(
    df: DataFrame, target: DataFrame | None, column: str, lookback: str, target_column: str | None = None
) -> DataFrame:
    """Rows on or after the newest target date minus ``lookback``; everything on the first run.

    ``lookback`` is an interval such as ``3 days``. The bound is a one-row subquery over a single
    column of the target and is compared with the bare column, so that it reaches the scan.
    """
    if target is None:
        return df
    newest = target.agg(F.max(target_column or column).alias("m")).scalar()
    bound = F.coalesce(F.to_date(newest - F.expr(f"interval {lookback}")), F.lit("0001-01-01").cast("date"))
    return df.where(F.col(column) >= bound)


def refuse_schema_change(df: DataFrame, target: DataFrame) -> None:
    """Fail before a write when names or types differ from the target table."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    if have != want:
        added = sorted(set(have) - set(want))
        missing = sorted(set(want) - set(have))
        retyped = sorted(c for c in have if c in want and have[c] != want[c])
        raise ValueError(f"schema differs: added={added} missing={missing} retyped={retyped}")


def has_new_rows(df: DataFrame, column: str, since) -> bool:
    """Whether anything arrived after ``since``; stops at the first row found."""
    return not df.where(F.col(column) > F.lit(since)).select(column).limit(1).isEmpty()


def new_rows(df: DataFrame, column: str, since, name: str = "new_rows") -> DataFrame:
    """The same as a one-row frame, for use inside a plan: whether anything arrived after ``since``."""
    first = df.where(F.col(column) > F.lit(since)).select(column).limit(1)
    return first.agg((F.count(F.lit(1)) > 0).alias(name))
