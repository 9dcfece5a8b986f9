"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).desc() if isinstance(o, str) else o for o in order]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the newest row of each key; ``order`` names the version, then the tie-breaks.

    The rank filter is planned with a partial group limit, so each map task sends at most one row
    per key and a hot key never gathers in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def apply_cdc(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], op: str = "op"
) -> DataFrame:
    """Current state of a change log: the newest event per key, gone when that is a delete."""
    return latest_by(df, keys, order).where(F.col(op) != "d")


def deduplicate(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """One row per key in the given order; rows holding NULLs are kept like any other."""
    w = Window.partitionBy(*partition_by).orderBy(
        *[F.col(o) if isinstance(o, str) else o for o in order_by]
    )
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
