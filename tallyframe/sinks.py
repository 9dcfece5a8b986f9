"""Writes: appends, keyed upserts and slice replacement on plain Parquet, exports and retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.incremental import refuse_schema_change
from tallyframe.operators.latest import latest_by
from tallyframe.session import shared_path


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _write(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str, sort_by: Sequence[str] = ()
) -> None:
    """Rebalanced by partition, so a large partition becomes several files and small ones one; sorted
    files let readers skip row groups."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append_raw(df: DataFrame, path: str, ts: str = "created_at", at: Column | None = None) -> None:
    """Append with an ingestion stamp, partitioned by the month of ``ts``."""
    stamped = df.withColumn("_ingested_at", F.current_timestamp() if at is None else at).withColumn(
        "month", F.date_format(ts, "yyyyMM")
    )
    _write(stamped, path, ["month"], "append", sort_by=[ts])


def remove_folder(path: str) -> None:
    """Delete a folder this module made and needs no more."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    fs, where = pafs.FileSystem.from_uri(path)
    fs.delete_dir(where)


def exists(path: str) -> bool:
    """Whether there is a file or folder at a path."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    fs, where = pafs.FileSystem.from_uri(path)
    return fs.get_file_info(where).type != pafs.FileType.NotFound


def rewrite_touched(
    spark: SparkSession,
    incoming: DataFrame,
    target: str,
    partition_by: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    keys: Sequence[str] = (),
    fixed: Sequence[str] = (),
) -> None:
    """Merge into the partitions that the incoming rows touch, and leave the others alone.

    Touched are the partitions of the incoming rows and, with ``keys``, those that hold one of their keys now: a row may
    have moved. ``fixed`` names partition columns that follow from the key, which limits that search. The merged partitions
    are written to a staging folder first and then replace the old ones, so no plan overwrites what it reads; a job
    that fails before the last step leaves the table as it was. Partitions that lose their last row are emptied.
    """
    found = read_table(spark, target)
    if found is None:
        _write(merge(incoming.limit(0), incoming), target, partition_by, "overwrite")
        return
    refuse_schema_change(incoming.drop(*partition_by), found.drop(*partition_by))
    # partition values come from folder names; the given schema keeps their type
    old = spark.read.schema(incoming.schema).parquet(target)
    # lists of partitions are as small as the table's folder list; as literals they prune the scan
    touched = [tuple(r) for r in incoming.select(*partition_by).distinct().collect()]
    if keys:
        reach = old
        for c in fixed:
            i = list(partition_by).index(c)
            reach = reach.where(F.col(c).isin(sorted({t[i] for t in touched})))
        held = reach.join(incoming.select(*keys).distinct(), list(keys), "left_semi").select(*partition_by).distinct()
        touched += [tuple(r) for r in held.collect()]
    kept = old
    for i, c in enumerate(partition_by):
        kept = kept.where(F.col(c).isin(sorted({t[i] for t in touched})))
    staging = shared_path(spark, "staging")
    _write(merge(kept.select(*incoming.columns), incoming).select(*incoming.columns), staging, partition_by, "overwrite")
    staged = spark.read.schema(incoming.schema).parquet(staging)
    file = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    before = kept.select(*partition_by, file.alias("_folder")).distinct()
    emptied = before.join(staged.select(*partition_by).distinct(), list(partition_by), "left_anti").collect()
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(target)
    for r in emptied:
        incoming.drop(*partition_by).limit(0).write.mode("overwrite").parquet(r["_folder"])
    remove_folder(staging)


def upsert_latest(
    spark: SparkSession, batch: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64
) -> None:
    """Keep the newest version per key. Keys hash into ``buckets`` partitions, so a batch rewrites
    only the buckets it touches. The number is part of the table's layout; another one is refused."""
    column = f"_bucket_of_{buckets}"
    found = read_table(spark, target)
    if found is not None and column not in found.columns:
        layout = [c for c in found.columns if c.startswith("_bucket_of_")]
        raise ValueError(f"{target} is laid out by {layout or 'other columns'}, not by {column}")
    hashed = batch.withColumn(column, F.pmod(F.hash(*keys), F.lit(buckets)))
    rewrite_touched(spark, hashed, target, [column], lambda old, new: latest_by(old.unionByName(new), keys, order))


def delete_insert(
    spark: SparkSession, df: DataFrame, target: str, unique_key: Sequence[str], partition_by: Sequence[str],
    fixed: Sequence[str] = (),
) -> None:
    """Incremental mart write: old rows with an incoming key go, in whatever partition they are, the incoming rows come."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        keys = new.select(*unique_key).distinct()
        return old.join(keys, list(unique_key), "left_anti").select(*new.columns).unionByName(new)

    rewrite_touched(spark, df, target, partition_by, merge, keys=unique_key, fixed=fixed)


def merge_features(spark: SparkSession, df: DataFrame, target: str) -> None:
    """Update or insert feature rows by ``(user_id, valid_from)``, across all versions.

    Partitioned by version and validity day; the day follows from the key, so a run reads and rewrites its days only.
    """
    dated = df.withColumn("valid_day", F.date_format("valid_from", "yyyyMMdd"))
    delete_insert(
        spark, dated, target, ["user_id", "valid_from"], ["feature_version", "valid_day"], fixed=["valid_day"]
    )


def append_serving(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Append to the serving store by format name, such as a JDBC table with its options."""
    writer = df.write.mode("append").format(fmt).options(**options)
    writer.save() if fmt == "jdbc" else writer.save(path)


def write_rows(df: DataFrame, path: str) -> None:
    """Plain distributed write, in place of client-side insert batches."""
    df.write.mode("overwrite").parquet(path)


def export_csv_audit(df: DataFrame, folder: str, version: str, snapshot: str) -> str:
    """CSV copy below ``version=/snapshot=``."""
    path = f"{folder}/version={version}/snapshot={snapshot}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def append_results(df: DataFrame, path: str) -> None:
    """Check results, partitioned by month."""
    _write(df.withColumn("month", F.date_format("check_time", "yyyyMM")), path, ["month"], "append")


def audit_events(
    df: DataFrame, event_time: Column, dag_id: Column, task_id: Column, run_id: Column, status: Column,
    duration: Column, details: Sequence[str],
) -> DataFrame:
    return df.select(
        event_time.alias("event_time"), dag_id.alias("dag_id"), task_id.alias("task_id"), run_id.alias("run_id"),
        status.alias("status"), duration.cast("double").alias("duration_seconds"),
        F.to_json(F.struct(*details)).alias("details"),
    )


def append_audit_event(df: DataFrame, path: str) -> None:
    _write(df.withColumn("month", F.date_format("event_time", "yyyyMM")), path, ["month"], "append")


def backfill(
    raw: dict[str, DataFrame], transforms: dict[str, Callable[[DataFrame], DataFrame]], target: str
) -> dict[str, str]:
    """Rebuild the silver tables from all raw rows with the transforms the stream uses."""
    paths = {}
    for table, fn in transforms.items():
        paths[table] = f"{target}/{table}"
        write_rows(fn(raw[table]), paths[table])
    return paths


def apply_retention(df: DataFrame, ts: str, interval: str, as_of: Column) -> DataFrame:
    """Rows not older than the interval; rows without a time stay."""
    return df.where(F.col(ts).isNull() | (F.col(ts) >= as_of - F.expr(f"interval {interval}")))


def compact_audit(
    spark: SparkSession, path: str, target: str, ts: str, as_of: Column, days: int = 7
) -> None:
    """Rewrite an audit folder without its old rows and in fewer files, into a new folder."""
    kept = apply_retention(spark.read.parquet(path), ts, f"{days} days", as_of)
    kept.hint("rebalance").write.mode("overwrite").parquet(target)
