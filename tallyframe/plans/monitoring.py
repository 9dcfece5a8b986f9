"""Dashboard, alert and service-level queries. ``as_of`` stands for now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.calendar import date_diff
from tallyframe.operators.quantiles import approx_quantiles, exact_quantiles
from tallyframe.plans.staging import recent


def top_merchants(kpis: DataFrame, n: int = 10) -> DataFrame:
    return (
        kpis.groupBy("merchant_id").agg(F.sum("gmv").cast("decimal(25,2)").alias("total_gmv"))
        .orderBy(F.desc("total_gmv"), "merchant_id").limit(n)
    )


def kpi_table(kpis: DataFrame, n: int | None = None) -> DataFrame:
    """All rows, in no order, or the ``n`` rows with the largest sales."""
    return kpis if n is None else kpis.orderBy(F.desc("gmv"), "merchant_id", "date").limit(n)


def approval_series(kpis: DataFrame) -> DataFrame:
    return kpis.select("date", "merchant_id", "approval_rate")


def instalment_share(kpis: DataFrame) -> DataFrame:
    return kpis.agg(F.avg("bnpl_penetration").alias("avg_bnpl_penetration"))


def decision_latency(tx: DataFrame, as_of: Column, interval: str = "24 hours", exact: bool = True) -> DataFrame:
    rows = recent(tx, "created_at", interval, as_of)
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    pick = exact_quantiles if exact else approx_quantiles
    return pick(rows, "decision_latency_ms", probs)


def feature_table_health(features: DataFrame) -> DataFrame:
    return features.groupBy("feature_version").agg(
        F.max("snapshot_ts").alias("last_update"), F.count(F.lit(1)).alias("row_count")
    )


def request_rates(log: DataFrame, unit: str = "minute", exact: bool = True) -> DataFrame:
    """Requests and p99 latency per minute or hour."""
    slots = log.select(F.date_trunc(unit, "event_time").alias("slot"), "latency_ms")
    counts = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("requests"))
    pick = exact_quantiles if exact else approx_quantiles
    p99 = pick(slots, "latency_ms", {"p99": 0.99}, ["slot"])
    return counts.join(p99, "slot", "left")


def staleness(df: DataFrame, column: str, as_of: Column, unit: str, name: str) -> DataFrame:
    """Unit boundaries between the newest row and now."""
    return df.agg(date_diff(unit, F.max(column), as_of).cast("bigint").alias(name))


def freshness_status(df: DataFrame, column: str, as_of: Column, max_hours: int) -> DataFrame:
    return staleness(df, column, as_of, "hour", "hours_stale").withColumn(
        "status", F.when(F.col("hours_stale") < max_hours, "PASS").otherwise("FAIL")
    )


def drift_overview(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count_if(F.col("is_drifted") == 1).alias("drifted"), F.max("drift_score").alias("max_score"),
        F.max("measured_at").alias("last_measured"),
    )


def newest(df: DataFrame, column: str, n: int, *tie: str) -> DataFrame:
    return df.orderBy(F.desc(column), *tie).limit(n)


# -- alerts: one row with the measure, its severity and whether it fires ------------------------------

def _alert(df: DataFrame, measure: str, fires: Column, severity: str) -> DataFrame:
    return df.select(
        F.col(measure).cast("double").alias("measure"), F.lit(severity).alias("severity"),
        F.coalesce(fires, F.lit(False)).alias("firing"),
    )


def approval_rate_drop(tx: DataFrame, as_of: Column, points: float = 15) -> DataFrame:
    """24 h baseline minus last hour, in points, from one pass with conditional counts."""
    day = recent(tx, "created_at", "24 hours", as_of)
    hour = F.col("created_at") >= as_of - F.expr("interval 1 hour")
    ok = F.col("status") == "approved"
    base = F.try_divide(F.count_if(ok) * 100.0, F.count(F.lit(1)).cast("double"))
    current = F.try_divide(F.count_if(ok & hour) * 100.0, F.count_if(hour).cast("double"))
    return _alert(
        day.agg((base - current).cast("double").alias("rate_drop")), "rate_drop", F.col("rate_drop") > points, "warning"
    )


def count_alert(df: DataFrame, condition: Column, limit: int, severity: str) -> DataFrame:
    """Fires when more than ``limit`` rows meet the condition."""
    return _alert(df.agg(F.count_if(condition).alias("n")), "n", F.col("n") > limit, severity)


def flatline_alert(df: DataFrame, column: str, as_of: Column, interval: str = "5 minutes") -> DataFrame:
    fresh = F.col(column) >= as_of - F.expr(f"interval {interval}")
    return _alert(df.agg(F.count_if(fresh).alias("n")), "n", F.col("n") < 1, "critical")


def staleness_alert(df: DataFrame, column: str, as_of: Column, unit: str, limit: int, severity: str) -> DataFrame:
    return _alert(staleness(df, column, as_of, unit, "age"), "age", F.col("age") > limit, severity)


# -- service levels ----------------------------------------------------------------------------------------

def slo_table(
    features: DataFrame, log: DataFrame, kpis: DataFrame, raw: DataFrame, recon: DataFrame,
    metrics: DataFrame, as_of: Column,
) -> DataFrame:
    """Six measures with target and verdict; latency is a real percentile over the request log."""

    def row(df: DataFrame, name: str, target: str, met: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("name"), F.lit(target).alias("target"),
            F.col("v").cast("double").alias("measured_value"), F.coalesce(met, F.lit(False)).alias("met"),
        )

    def age(df: DataFrame, c: str, unit: str) -> DataFrame:
        return staleness(df, c, as_of, unit, "v")

    v = F.col("v")
    parts = [
        row(age(features, "snapshot_ts", "hour"), "feature_freshness", "< 6 hours", v < 6),
        row(exact_quantiles(log, "latency_ms", {"v": 0.99}), "feature_read_p99", "< 50 ms", v < 50),
        row(age(kpis, "date", "hour"), "mart_freshness", "< 25 hours", v < 25),
        row(age(raw, "created_at", "second"), "ingestion_latency", "< 30 seconds", v < 30),
        row(recon.agg(F.count_if(F.col("settlement_date") == F.to_date(as_of)).alias("v")),
            "settlement_reconciliation", "by 6 AM", v > 0),
        row(age(metrics, "measured_at", "minute"), "drift_detection", "< 60 minutes", v < 60),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
