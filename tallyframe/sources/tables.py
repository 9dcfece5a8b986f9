"""Batch sources: source tables, remote tables, seed files and request logs."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_SCHEMAS = {"merchant_categories": "merchant_category string, risk_weight double, display_name string"}


class SourceCatalog:
    """Named source tables ``layer.table`` with their path, format and freshness column."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._entries: dict[str, dict] = {}

    def register(
        self, layer: str, table: str, path: str, fmt: str = "parquet", loaded_at: str | None = None,
        warn_hours: int | None = None, error_hours: int | None = None, schema: str | None = None,
    ) -> None:
        self._entries[f"{layer}.{table}"] = {
            "path": path, "fmt": fmt, "loaded_at": loaded_at, "warn_hours": warn_hours,
            "error_hours": error_hours, "schema": schema,
        }

    def freshness(self, layer: str, table: str) -> dict:
        e = self._entries[f"{layer}.{table}"]
        return {k: e[k] for k in ("loaded_at", "warn_hours", "error_hours")}

    def source(self, layer: str, table: str) -> DataFrame:
        e = self._entries[f"{layer}.{table}"]
        reader = self.spark.read.format(e["fmt"])
        if e["schema"]:
            reader = reader.schema(e["schema"])
        return reader.load(e["path"])


def read_source_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    predicate: str | None = None,
    ts_as_string: Sequence[str] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A table scan with predicate and columns pushed to the source, chosen times as text.

    For ``fmt='jdbc'`` the options must name a partition column with its bounds, so that the read is
    spread over executors.
    """
    options = dict(options or {})
    if fmt == "jdbc":
        need = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        if not need <= set(options):
            raise ValueError(f"a database read needs {sorted(need)}")
    df = spark.read.format(fmt).options(**options).load(*([path] if fmt != "jdbc" else []))
    if predicate:
        df = df.where(predicate)
    if columns:
        df = df.select(*columns)
    return df.withColumns({c: F.col(c).cast("string") for c in ts_as_string}) if ts_as_string else df


def read_seed(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A static dimension from its CSV file."""
    base = Path(folder) if folder else Path(__file__).resolve().parent.parent / "seeds"
    with (base / f"{name}.csv").open(newline="") as f:
        rows = list(csv.reader(f))[1:]
    fields = [f.split() for f in SEED_SCHEMAS[name].split(", ")]
    typed = [
        tuple(float(v) if kind == "double" else v for v, (_, kind) in zip(r, fields)) for r in rows
    ]
    return spark.createDataFrame(typed, SEED_SCHEMAS[name])


def read_request_log(df: DataFrame, time: str, latency: str, route: str) -> DataFrame:
    """Any log frame under the column names the latency reports use."""
    return df.select(
        F.col(time).alias("event_time"), F.col(latency).cast("double").alias("latency_ms"), F.col(route).alias("route")
    )
