"""Schema expectations on stored tables, file by file.

A table of Parquet files has as many schemas as files: a late deployment or a partial backfill leaves files with a missing,
renamed, retyped or extra column, which a reader that takes one schema for all does not show. Here tasks read the
footers of the files (no data), and every expectation is evaluated for every file; an issue carries the number of files
and rows it concerns. All expectations of a table, and all tables, share one job.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILES = "table_name string, file string, file_rows long, columns array<struct<name:string,type:string>>"
# Arrow's names of simple types as Spark writes them
_TYPES = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float", "double": "double",
    "bool": "boolean", "string": "string", "large_string": "string", "binary": "binary", "large_binary": "binary",
    "date32[day]": "date",
}


def _type(kind: pa.DataType) -> str:
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_list(kind):
        return f"array<{_type(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return "struct<" + ",".join(f"{f.name}:{_type(f.type)}" for f in kind) + ">"
    return _TYPES.get(str(kind), str(kind))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, rows, columns = [], [], []
        for uri in batch.column("file").to_pylist():
            where = "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri
            fs, path = pafs.FileSystem.from_uri(where)
            with fs.open_input_file(path) as f:
                meta = pq.read_metadata(f)
            names.append(uri)
            rows.append(meta.num_rows)
            columns.append([{"name": c.name, "type": _type(c.type)} for c in meta.schema.to_arrow_schema()])
        kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("table_name"), pa.array(names), pa.array(rows, pa.int64()), pa.array(columns, kind)],
            names=["table_name", "file", "file_rows", "columns"],
        )


def files_of(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per file of the stored tables: ``table_name, file, file_rows, columns``. Only file names pass the driver."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, file) for name, df in tables.items() for file in df.inputFiles()]
    listed = spark.createDataFrame(rows, "table_name string, file string")
    return listed.repartition(max(1, min(len(rows), 1000)), "file").mapInArrow(_footers, FILES)


# -- expectations: arrays of (check, column_name, expected, found) for a file ----------------------------------

_ISSUE = "array<struct<check:string,column_name:string,expected:string,found:string>>"


def _names() -> Column:
    return F.transform("columns", lambda c: F.lower(c["name"]))


def _issue(check: str, column: Column, expected: Column, found: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), column.alias("column_name"), expected.alias("expected"), found.alias("found"))


def _when(bad: Column, issue: Column) -> Column:
    return F.when(bad, F.array(issue)).otherwise(F.array().cast(_ISSUE))


def column_exists(column: str, index: int | None = None) -> Column:
    """The column is in the file, at a place (from 0) if one is given."""
    at = F.array_position(_names(), column.lower())
    missing = _issue("column_exists", F.lit(column), F.lit("present"), F.lit("missing"))
    if index is None:
        return _when(at == 0, missing)
    moved = _issue("column_position", F.lit(column), F.lit(str(index)), (at - 1).cast("string"))
    return F.when(at == 0, F.array(missing)).otherwise(_when(at != index + 1, moved))


def column_count_between(lo: int | Column | None = None, hi: int | Column | None = None) -> Column:
    n, none = F.size("columns"), F.lit(False)
    bound = lambda b: F.lit(b) if not isinstance(b, Column) else b
    bad = (none if lo is None else n < bound(lo)) | (none if hi is None else n > bound(hi))
    text = F.concat(F.coalesce(bound(lo).cast("string"), F.lit("None")), F.lit(".."), F.coalesce(bound(hi).cast("string"), F.lit("None")))
    return _when(bad, _issue("column_count", F.lit("*"), text, n.cast("string")))


def column_count_equal(value: int | Column) -> Column:
    return column_count_between(value, value)


def columns_of(files: DataFrame) -> Column:
    """The largest number of columns among the files of another table, as a one-row subquery."""
    return files.agg(F.max(F.size("columns")).alias("n")).scalar()


def columns_contain(columns: Sequence[str]) -> Column:
    return F.concat(*[column_exists(c) for c in columns])


def columns_not_contain(columns: Sequence[str]) -> Column:
    return F.concat(*[
        _when(F.array_contains(_names(), c.lower()), _issue("column_banned", F.lit(c), F.lit("missing"), F.lit("present"))) for c in columns
    ])


def columns_match_set(columns: Sequence[str]) -> Column:
    want = F.array(*[F.lit(c.lower()) for c in columns])
    extra = F.transform(
        F.filter("columns", lambda c: ~F.array_contains(want, F.lower(c["name"]))),
        lambda c: _issue("column_extra", c["name"], F.lit("missing"), F.lit("present")),
    )
    return F.concat(columns_contain(columns), extra)


def columns_match_ordered(columns: Sequence[str]) -> Column:
    """Names place by place; ``-`` stands for a place that one side does not have."""
    want = F.array(*[F.lit(c.lower()) for c in columns])
    pairs = F.zip_with(_names(), want, lambda h, w: F.struct(F.coalesce(h, F.lit("-")).alias("h"), F.coalesce(w, F.lit("-")).alias("w")))
    return F.transform(F.filter(pairs, lambda p: p["h"] != p["w"]), lambda p: _issue("column_position", p["w"], p["w"], p["h"]))


def type_in(column: str, types: Sequence[str]) -> Column:
    """The column, where a file has it, is of one of the types."""
    own = F.filter("columns", lambda c: F.lower(c["name"]) == column.lower())
    odd = F.filter(own, lambda c: ~c["type"].isin(list(types)))
    return F.transform(odd, lambda c: _issue("column_type", F.lit(column), F.lit("|".join(types)), c["type"]))


def issues(files: DataFrame, expectations: dict[str, Sequence[Column]]) -> DataFrame:
    """All issues of the named tables: ``table_name, check, column_name, expected, found, files, file_rows``."""
    found = F.lit(None).cast(_ISSUE)
    for table, some in expectations.items():
        found = F.when(F.col("table_name") == table, F.concat(*[e.cast(_ISSUE) for e in some])).otherwise(found)
    return files.select("table_name", "file_rows", F.explode(found).alias("_i")).groupBy("table_name", "_i").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_rows").alias("file_rows")
    ).select("table_name", "_i.*", "files", "file_rows")


def coverage(files: DataFrame, contract: dict[str, Sequence[str]]) -> DataFrame:
    """Per table its rows, and the number of contract columns that some file lacks."""
    missing = issues(files, {t: [columns_contain(columns)] for t, columns in contract.items()}).groupBy("table_name").agg(
        F.count_distinct("column_name").alias("missing")
    )
    rows = files.groupBy("table_name").agg(F.sum("file_rows").alias("row_count"))
    return rows.join(missing, "table_name", "left").select("table_name", "row_count", F.coalesce("missing", F.lit(0)).alias("missing"))
