"""Schema contracts: what a table must look like, checked on its schema and its data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ISSUE_SCHEMA = "check string, column_name string, expected string, found string, rows_failed bigint"


def _issues(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, ISSUE_SCHEMA)


def column_to_exist(df: DataFrame, column: str, index: int | None = None) -> list[tuple]:
    names = [c.lower() for c in df.columns]
    if column.lower() not in names:
        return [("column_exists", column, "present", "missing", 0)]
    if index is not None and names.index(column.lower()) != index:
        return [("column_position", column, str(index), str(names.index(column.lower())), 0)]
    return []


def column_count_between(df: DataFrame, lo: int | None = None, hi: int | None = None) -> list[tuple]:
    n = len(df.columns)
    bad = (lo is not None and n < lo) or (hi is not None and n > hi)
    return [("column_count", "*", f"{lo}..{hi}", str(n), 0)] if bad else []


def column_count_equal(df: DataFrame, value: int) -> list[tuple]:
    return column_count_between(df, value, value)


def column_count_equal_other(a: DataFrame, b: DataFrame) -> list[tuple]:
    return column_count_equal(a, len(b.columns))


def columns_contain_set(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    have = {c.lower() for c in df.columns}
    return [("column_exists", c, "present", "missing", 0) for c in columns if c.lower() not in have]


def columns_not_contain_set(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    have = {c.lower() for c in df.columns}
    return [("column_banned", c, "missing", "present", 0) for c in columns if c.lower() in have]


def columns_match_set(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    want = {c.lower() for c in columns}
    extra = [("column_extra", c, "missing", "present", 0) for c in df.columns if c.lower() not in want]
    return columns_contain_set(df, columns) + extra


def columns_match_ordered_list(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    have = [c.lower() for c in df.columns]
    want = [c.lower() for c in columns]
    width = max(len(have), len(want))
    pad = lambda xs: xs + ["-"] * (width - len(xs))
    return [
        ("column_position", w, w, h, 0) for h, w in zip(pad(have), pad(want)) if h != w
    ]


def type_in(df: DataFrame, column: str, types: Sequence[str]) -> list[tuple]:
    found = df.schema[column].dataType.simpleString()
    return [] if found in types else [("column_type", column, "|".join(types), found, 0)]


def of_type(df: DataFrame, column: str, kind: str) -> list[tuple]:
    return type_in(df, column, [kind])


def issues_frame(df: DataFrame, issues: list[tuple]) -> DataFrame:
    return _issues(df, issues)


def schema_contract(
    df: DataFrame,
    contract: Sequence[tuple[str, str, bool]],
    ordered: bool = False,
    exact: bool = False,
) -> DataFrame:
    """All issues of a table against ``(column, type, nullable)`` rows.

    Names, order and types come from the schema alone. Columns that must not be NULL are proven on
    the data, all in one scan of just those columns.
    """
    names = [c for c, _, _ in contract]
    present = {c.lower() for c in df.columns}
    issues = columns_match_set(df, names) if exact else columns_contain_set(df, names)
    if ordered:
        issues += columns_match_ordered_list(df, names)
    for c, kind, _ in contract:
        if c.lower() in present:
            issues += of_type(df, c, kind)
    static = _issues(df, issues)
    required = [c for c, _, nullable in contract if not nullable and c.lower() in present]
    if not required:
        return static
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    proven = nulls.unpivot([], required, "column_name", "rows_failed").where("rows_failed > 0").select(
        F.lit("not_null").alias("check"), "column_name", F.lit("no NULL").alias("expected"),
        F.lit("NULL").alias("found"), F.col("rows_failed").cast("bigint"),
    )
    return static.unionByName(proven)


def schema_drift(raw_json: DataFrame, value: str, known: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    """Fields that appear in JSON records but not in the table, with the number of records."""
    skip = [c.lower() for c in [*known, *ignored]]
    return (
        raw_json.select(F.explode(F.json_object_keys(value)).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(~F.lower("field").isin(skip))
    )
