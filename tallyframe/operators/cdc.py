"""Change events to typed raw rows, silver rows and audit rows.

Every function takes a batch or a streaming frame: only projections and filters, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import (
    best_effort_ts,
    decimal_of,
    int_or_zero,
    mask_field,
    micros_to_ts,
    millis_to_ts,
    text_or_days_to_date,
)

META = ["__op", "__source_ts_ms"]
# Fixed value: rows of the document store at or before this time carry no real date.
ZERO_DATE = "2000-01-01"


def flatten_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """before/after/op/source envelope to a flat row; tombstones drop, deletes keep the old row."""
    v = F.col(value)
    return df.where(v.isNotNull()).select(
        F.coalesce(v["after"], v["before"]).alias("_row"),
        v["op"].alias("__op"),
        v["source"]["ts_ms"].alias("__source_ts_ms"),
        F.when(v["op"] == "d", "true").otherwise("false").alias("__deleted"),
    ).select("_row.*", "__op", "__source_ts_ms", "__deleted")


def mask(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: mask_field() for c in columns})


def _typed(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return df.withColumns(changes)


def type_transactions(df: DataFrame) -> DataFrame:
    return _typed(df, {
        "amount": decimal_of(F.col("amount"), 2),
        "created_at": micros_to_ts(F.col("created_at")),
    })


def type_repayments(df: DataFrame) -> DataFrame:
    return _typed(df, {
        "amount": decimal_of(F.col("amount"), 2),
        "due_date": text_or_days_to_date(F.col("due_date")),
        "paid_at": micros_to_ts(F.col("paid_at")),
        "created_at": micros_to_ts(F.col("created_at")),
        "updated_at": micros_to_ts(F.col("updated_at")),
    })


def type_users(df: DataFrame) -> DataFrame:
    return _typed(df, {
        "credit_limit": decimal_of(F.col("credit_limit"), 2),
        "created_at": micros_to_ts(F.col("created_at")),
        "updated_at": micros_to_ts(F.col("updated_at")),
    })


def type_merchants(df: DataFrame) -> DataFrame:
    return _typed(df, {
        "commission_rate": decimal_of(F.col("commission_rate"), 4),
        "credit_limit": decimal_of(F.col("credit_limit"), 2),
        "created_at": micros_to_ts(F.col("created_at")),
        "updated_at": micros_to_ts(F.col("updated_at")),
    })


def type_installments(df: DataFrame) -> DataFrame:
    return _typed(df, {
        "total_amount": decimal_of(F.col("total_amount"), 2),
        "installment_amount": decimal_of(F.col("installment_amount"), 2),
        "start_date": text_or_days_to_date(F.col("start_date")),
        "end_date": text_or_days_to_date(F.col("end_date")),
        "created_at": micros_to_ts(F.col("created_at")),
    })


def type_app_events(df: DataFrame) -> DataFrame:
    return _typed(df, {"created_at": best_effort_ts(F.col("created_at"))})


def type_merchant_sessions(df: DataFrame) -> DataFrame:
    return _typed(df, {"created_at": best_effort_ts(F.col("created_at"))})


def _alive(df: DataFrame, drop: Sequence[str] = META) -> DataFrame:
    return df.where(F.col("__op") != "d").drop(*drop)


def silver_transactions(df: DataFrame) -> DataFrame:
    return _alive(df)


def silver_repayments(df: DataFrame) -> DataFrame:
    return _alive(df)


def silver_installments(df: DataFrame) -> DataFrame:
    return _alive(df)


def silver_users(df: DataFrame) -> DataFrame:
    return _alive(
        df.withColumn("_version", F.col("__source_ts_ms")).withColumnRenamed("national_id", "national_id_hash")
    )


def silver_merchants(df: DataFrame) -> DataFrame:
    return _alive(df.withColumn("_version", F.col("__source_ts_ms")))


def _dated(df: DataFrame) -> DataFrame:
    return df.where(F.col("created_at") > F.lit(ZERO_DATE).cast("timestamp"))


def silver_app_events(df: DataFrame) -> DataFrame:
    """Ids as numbers (0 when unreadable), empty merchant as NULL, zero dates dropped."""
    return _dated(df).withColumns({
        "user_id": int_or_zero(F.col("user_id")),
        "merchant_id": F.when(
            F.nullif(F.col("merchant_id"), F.lit("")).isNotNull(), int_or_zero(F.col("merchant_id"), "int")
        ),
    })


def silver_merchant_sessions(df: DataFrame) -> DataFrame:
    return _dated(df).withColumn("merchant_id", int_or_zero(F.col("merchant_id"), "int"))


def _audit(frames: dict[str, tuple[DataFrame, str]], op: str, time_name: str) -> DataFrame:
    parts = []
    for table, (df, key) in frames.items():
        source_time = millis_to_ts(F.col("__source_ts_ms"))
        parts.append(
            df.where(F.col("__op") == op).select(
                F.lit(table).alias("source_table"),
                F.col(key).cast("string").alias("record_id"),
                source_time.alias(time_name),
                source_time.alias("source_ts"),
                F.to_json(F.struct(*[c for c in df.columns if c not in META])).alias("raw_payload"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def delete_audit(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Deletes of several tables, given as ``{table: (raw frame, key column)}``, in one log."""
    return _audit(frames, "d", "deleted_at")


def update_audit(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    return _audit(frames, "u", "updated_at")


EVENT_DATA_SCHEMA = "page string, referrer string, geo struct<lat: double, lon: double>, k bigint"


def parse_event_data(df: DataFrame, column: str = "event_data", schema: str = EVENT_DATA_SCHEMA) -> DataFrame:
    """Known payload fields of all payload versions; single-quoted JSON is accepted."""
    parsed = F.from_json(F.col(column), schema, {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    return df.withColumn("_p", parsed).select(
        *df.columns, F.col("_p.page").alias("page"), F.col("_p.referrer").alias("referrer"),
        F.col("_p.geo.lat").alias("geo_lat"), F.col("_p.geo.lon").alias("geo_lon"),
        F.col("_p.k").alias("payload_k"),
    )


def stamp_ingest(df: DataFrame, at: Column | None = None) -> DataFrame:
    return df.withColumn("_ingested_at", F.current_timestamp() if at is None else at)


def initial_snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, snapshot_ts_ms: int = 0) -> DataFrame:
    """First load tagged as reads, then the change events."""
    tagged = snapshot.withColumns({
        "__op": F.lit("r"), "__source_ts_ms": F.lit(snapshot_ts_ms).cast("bigint")
    })
    return tagged.unionByName(changes)


def bad_dates(df: DataFrame, column: str, as_of: Column) -> Column:
    """Zero dates and dates in a year beyond next year, which would poison a watermark."""
    ts = F.col(column)
    return ts.isNull() | (ts <= F.lit(ZERO_DATE).cast("timestamp")) | (F.year(ts) > F.year(as_of) + 1)
