"""Change streams and event streams as streaming frames, and raw events derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.contracts import CHANGE_SCHEMAS
from tallyframe.sources import domain


def as_glob(path: str) -> str:
    """The path as a pattern matching just itself; a file stream then takes a file or a folder."""
    return f"{path[:-1]}[{path[-1]}]"


def read_cdc_stream(
    spark: SparkSession, table: str, path: str | None = None, fmt: str = "json", options: dict | None = None,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Change events of one table as a stream of flat rows.

    ``fmt`` is a file format, or ``kafka`` with its options where that package is installed.
    """
    schema = CHANGE_SCHEMAS[table]
    options = dict(options or {})
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).options(**options).load(path)


def read_json_stream(spark: SparkSession, table: str, path: str, keep_bad: bool = True) -> DataFrame:
    """One JSON object per line. Unreadable lines stay as rows with ``_corrupt_record`` set."""
    schema = CHANGE_SCHEMAS[table] + (", _corrupt_record string" if keep_bad else "")
    text = spark.readStream.format("text").load(path)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return text.select(F.from_json("value", schema, opts).alias("r")).select("r.*")


def read_table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream with its own schema."""
    schema = domain.raw(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(as_glob(f"{sf_dir}/{name}.parquet"))


# -- raw change events over the given tables: text decimals, epoch micros, an operation and a time ----

def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def _op(key: str):
    """Operation by key: one in ten deleted, two updated, the rest created."""
    slot = F.col(key) % 10
    return F.when(slot == 0, "d").when(slot <= 2, "u").otherwise("c")


def transaction_events(tx: DataFrame) -> DataFrame:
    return tx.withColumns({
        "amount": F.col("amount").cast("string"),
        "created_at": _micros("created_at"),
        "__op": _op("transaction_id"),
        "__source_ts_ms": F.unix_millis(F.col("created_at").cast("timestamp")),
    })


def repayment_events(versions: DataFrame) -> DataFrame:
    return versions.select(
        "repayment_id", "transaction_id", "user_id", "installment_number",
        F.col("amount").cast("string").alias("amount"), F.col("due_date").cast("string").alias("due_date"),
        _micros("paid_at").alias("paid_at"), F.lower("status").alias("status"),
        _micros("updated_at").alias("created_at"), _micros("updated_at").alias("updated_at"),
        F.col("op").alias("__op"), F.unix_millis(F.col("updated_at").cast("timestamp")).alias("__source_ts_ms"),
    )


# Fixed value: the time stamped on rows of tables that carry no time of their own.
LOAD_MICROS = 788918400000000  # 1995-01-01


def user_events(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", "full_name", "email", F.lit(None).cast("string").alias("phone"),
        F.sha2(F.col("user_id").cast("string"), 256).alias("national_id"),
        F.col("credit_limit").cast("string").alias("credit_limit"), "credit_tier", "kyc_status",
        F.lit(LOAD_MICROS).alias("created_at"), F.lit(LOAD_MICROS).alias("updated_at"),
        _op("user_id").alias("__op"), (F.lit(LOAD_MICROS // 1000) + F.col("user_id")).alias("__source_ts_ms"),
    )


def merchant_events(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id", "merchant_name", "merchant_category", "risk_tier",
        F.col("commission_rate").cast("string").alias("commission_rate"),
        F.col("credit_limit").cast("string").alias("credit_limit"), "country",
        F.lit(LOAD_MICROS).alias("created_at"), F.lit(LOAD_MICROS).alias("updated_at"),
        _op("merchant_id").alias("__op"), (F.lit(LOAD_MICROS // 1000) + F.col("merchant_id")).alias("__source_ts_ms"),
    )


def installment_events(schedules: DataFrame) -> DataFrame:
    n = F.col("installment_count")
    return schedules.select(
        "schedule_id", "transaction_id", "user_id", F.col("total_amount").cast("string").alias("total_amount"),
        "installment_count",
        # whole cents, rounded down
        (F.floor(F.col("total_amount") * 100 / n) / 100).cast("decimal(12,2)").cast("string").alias("installment_amount"),
        F.col("start_date").cast("string").alias("start_date"),
        F.unix_date(F.add_months("start_date", n)).cast("string").alias("end_date"),
        "status", _micros("created_at").alias("created_at"),
        _op("schedule_id").alias("__op"), F.unix_millis(F.col("created_at").cast("timestamp")).alias("__source_ts_ms"),
    )


def app_event_records(events: DataFrame) -> DataFrame:
    """Text records as the document store sends them: text ids, ISO times, some ids unreadable."""
    odd = F.col("event_id") % 11 == 0
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(odd, F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string")).alias("user_id"),
        "event_type",
        F.when(F.col("event_id") % 3 == 0, "").otherwise((F.col("user_id") % 100).cast("string")).alias("merchant_id"),
        F.concat_ws("-", "user_id", F.date_format("created_at", "yyyyMMdd")).alias("session_id"),
        F.lit("web").alias("device_type"), "event_data",
        F.when(F.col("event_id") % 13 == 0, "1970-01-01T00:00:00Z")
        .otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("created_at"),
    )


def merchant_session_records(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("session_id"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise((F.col("user_id") % 100).cast("string")).alias("merchant_id"),
        F.col("event_type").alias("action"), F.lit("dashboard").alias("page"),
        F.col("value").cast("int").alias("duration_seconds"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
    )
