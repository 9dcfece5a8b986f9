"""Staging projections over the silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.latest import latest_by


def stg_transactions(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("status") != "cancelled")


def stg_repayments(versions: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_by(versions, keys, order).withColumn("status", F.lower("status"))


def stg_users(versions: DataFrame, order: Sequence[str] = ("_version",)) -> DataFrame:
    return latest_by(versions, ["user_id"], order)


def stg_merchants(versions: DataFrame, order: Sequence[str] = ("_version",)) -> DataFrame:
    return latest_by(versions, ["merchant_id"], order)


def stg_app_events(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    return events.select(*columns)


def recent(df: DataFrame, ts: str, interval: str, as_of: Column) -> DataFrame:
    """Rows of the last ``interval`` before ``as_of``."""
    return df.where(F.col(ts) >= as_of - F.expr(f"interval {interval}"))
