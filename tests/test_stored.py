"""Schema expectations against files whose schemas differ."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.checks import stored


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("mixed"))
    base = spark.range(10).select("id", F.lit(Decimal("1.50")).cast("decimal(12,2)").alias("Amount"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    base.coalesce(1).write.mode("append").parquet(path)
    base.limit(4).drop("day").coalesce(1).write.mode("append").parquet(path)
    base.limit(3).select("Amount", "id", "day", F.lit("x").alias("note")).coalesce(1).write.mode("append").parquet(path)
    base.limit(2).withColumn("Amount", F.lit(1.5)).coalesce(1).write.mode("append").parquet(path)
    return stored.files_of({"t": spark.read.parquet(path)})


def found(files, *expectations):
    rows = stored.issues(files, {"t": expectations}).collect()
    return sorted((r.check, r.column_name, r.expected, r.found, r.files, r.file_rows) for r in rows)


def test_footers_name_columns_types_and_rows(files):
    got = sorted((r.file_rows, [(c.name, c.type) for c in r.columns]) for r in files.collect())
    assert got == [
        (2, [("id", "bigint"), ("Amount", "double"), ("day", "date")]),
        (3, [("Amount", "decimal(12,2)"), ("id", "bigint"), ("day", "date"), ("note", "string")]),
        (4, [("id", "bigint"), ("Amount", "decimal(12,2)")]),
        (10, [("id", "bigint"), ("Amount", "decimal(12,2)"), ("day", "date")]),
    ]


def test_each_expectation_names_the_files_that_break_it(files):
    assert found(files, stored.column_exists("DAY")) == [("column_exists", "DAY", "present", "missing", 1, 4)]
    assert found(files, stored.column_exists("amount", 1)) == [("column_position", "amount", "1", "0", 1, 3)]
    assert found(files, stored.column_count_between(3, 3)) == [("column_count", "*", "3..3", "2", 1, 4), ("column_count", "*", "3..3", "4", 1, 3)]
    assert found(files, stored.column_count_between(None, 3)) == [("column_count", "*", "None..3", "4", 1, 3)]
    assert found(files, stored.column_count_equal(stored.columns_of(files))) == [
        ("column_count", "*", "4..4", "2", 1, 4), ("column_count", "*", "4..4", "3", 2, 12)]
    assert found(files, stored.columns_not_contain(["note", "fee"])) == [("column_banned", "note", "missing", "present", 1, 3)]
    assert found(files, stored.columns_match_set(["id", "amount", "day"])) == [
        ("column_exists", "day", "present", "missing", 1, 4), ("column_extra", "note", "missing", "present", 1, 3)]
    assert found(files, stored.columns_match_ordered(["id", "amount"])) == [
        ("column_position", "-", "-", "day", 3, 15), ("column_position", "-", "-", "note", 1, 3),
        ("column_position", "amount", "amount", "id", 1, 3), ("column_position", "id", "id", "amount", 1, 3)]
    assert found(files, stored.type_in("amount", ["decimal(12,2)"])) == [("column_type", "amount", "decimal(12,2)", "double", 1, 2)]
    assert found(files, stored.column_exists("id"), stored.type_in("nothing", ["int"])) == []


def test_coverage_counts_columns_that_some_file_lacks(files):
    (r,) = stored.coverage(files, {"t": ["id", "day", "note", "fee"]}).collect()
    assert (r.table_name, r.row_count, r.missing) == ("t", 19, 3)
