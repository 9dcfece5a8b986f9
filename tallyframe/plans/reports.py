"""Cross-table reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.ordered import ROWS_PER_SEGMENT, with_previous
from tallyframe.operators.tables import haversine, url_host, url_parameter, url_path


def latest_run_status(audit: DataFrame) -> DataFrame:
    """Newest status per pipeline; a mergeable ``max_by``, so a busy pipeline is no hot spot."""
    return audit.groupBy("dag_id").agg(
        F.max("event_time").alias("last_event"),
        F.max_by("status", F.struct("event_time", "run_id")).alias("status"),
        F.count(F.lit(1)).alias("runs"),
    )


def web_attribution(pages: DataFrame, url: str = "url", source_parameter: str = "utm_source") -> DataFrame:
    """Pages per host and campaign source, with the number of distinct paths."""
    u = F.col(url)
    return (
        pages.select(
            url_host(u).alias("host"), url_path(u).alias("path"), url_parameter(u, source_parameter).alias("source")
        )
        .groupBy("host", "source")
        .agg(F.count(F.lit(1)).alias("pages"), F.count_distinct("path").alias("paths"))
    )


def movement(
    events: DataFrame, keys: list[str], order: list[str], lat: str = "geo_lat", lon: str = "geo_lon",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Kilometres between consecutive geo events of a user."""
    located = events.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    prev = with_previous(located, keys, order, [lat, lon], "_from", rows_per_segment=rows_per_segment)
    p = F.col("_from")
    return prev.where(p.isNotNull()).withColumn(
        "distance_km", haversine(p[lat], p[lon], F.col(lat), F.col(lon), "km")
    ).drop("_from")


def kpis_by_calendar(kpis: DataFrame, dates: DataFrame, fiscal: DataFrame | None = None) -> DataFrame:
    """Daily money with ISO week, fiscal period and the same weekday a year before.

    KPIs shrink to one row per day before they meet the calendar.
    """
    daily = kpis.groupBy("date").agg(
        F.sum("gmv").cast("decimal(25,2)").alias("gmv"),
        F.sum("transaction_count").cast("bigint").alias("transaction_count"),
    )
    cal = dates.select(
        F.col("date_day").alias("date"), "iso_week_of_year", "day_of_week_name_short", "prior_year_over_year_date_day"
    )
    out = daily.join(cal, "date")
    if fiscal is not None:
        out = out.join(
            fiscal.select(F.col("date_day").alias("date"), "fiscal_year_number", "fiscal_period_number"), "date", "left"
        )
    before = daily.select(F.col("date").alias("prior_year_over_year_date_day"), F.col("gmv").alias("prior_year_gmv"))
    return out.join(before, "prior_year_over_year_date_day", "left")


def consumption_mix(raw: DataFrame, tx: DataFrame, kpis: DataFrame, metrics: DataFrame, as_of) -> DataFrame:
    """The mixed analytical load as rows of (query, key, value)."""
    day = F.col("created_at") >= as_of - F.expr("interval 1 day")

    def row(df: DataFrame, name: str, key, value) -> DataFrame:
        return df.select(F.lit(name).alias("query"), key.cast("string").alias("key"), value.cast("double").alias("value"))

    none = F.lit(None)
    parts = [
        row(raw.agg(F.count(F.lit(1)).alias("v")), "raw_rows", none, F.col("v")),
        row(tx.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("v")), "tx_per_merchant", F.col("merchant_id"), F.col("v")),
        row(tx.agg(F.sum(F.when(day, F.col("amount"))).alias("v")), "recent_amount", none, F.col("v")),
        row(kpis.agg(F.avg(F.col("gmv").cast("double")).alias("v")), "avg_mart_gmv", none, F.round("v", 6)),
        row(metrics.groupBy("feature_name").agg(F.avg("drift_score").alias("v")), "avg_drift", F.col("feature_name"), F.round("v", 6)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
