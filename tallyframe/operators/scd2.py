"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.asof import asof_join
from tallyframe.operators.ordered import ROWS_PER_SEGMENT, place, with_next, with_previous


def scd2_check(
    source: DataFrame,
    snapshot: DataFrame | None,
    key: str,
    check_cols: Sequence[str],
    as_of: Column,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The snapshot after one run: changed keys get a closed and a new version.

    ``snapshot`` has the columns of ``source`` plus ``valid_from`` and ``valid_to``; ``None`` is the
    first run. Closed history passes through untouched; the open rows meet the source in one full
    join and every joined row yields its zero, one or two versions in place.
    """
    cols = source.columns
    if snapshot is None:
        return source.select(
            *cols, as_of.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")
        )
    closed = snapshot.where(F.col("valid_to").isNotNull())
    old = snapshot.where(F.col("valid_to").isNull()).select(
        F.col(key).alias("_old_key"), F.struct(*cols, "valid_from").alias("_old")
    )
    new = source.select(F.col(key).alias("_new_key"), F.struct(*cols).alias("_new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col("_old")[c].eqNullSafe(F.col("_new")[c])
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    ends = (has_old & has_new & ~same) | (has_old & ~has_new & F.lit(invalidate_hard_deletes))

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(side)[c].alias(c) for c in cols],
            start.cast("timestamp_ntz").alias("valid_from"),
            end.cast("timestamp_ntz").alias("valid_to"),
        )

    never = F.lit(None)
    kept = F.when(has_old, version("_old", F.col("_old")["valid_from"], F.when(ends, as_of)))
    added = F.when(has_new & (~has_old | ~same), version("_new", as_of, never))
    return closed.select(*cols, "valid_from", "valid_to").unionByName(
        both.select(F.inline(F.filter(F.array(kept, added), lambda v: v.isNotNull())))
    )


def scd2_current(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(F.col("valid_to").isNull())


def scd2_as_of(
    snapshot: DataFrame, facts: DataFrame, key: str, at: str, values: Sequence[str]
) -> DataFrame:
    """Which version held when each fact happened."""
    return asof_join(facts, snapshot, [key], at, "valid_from", "valid_to", values, overlapping=False)


def scd2_from_log(
    log: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    order: Sequence[str],
    at: str,
    op: str = "op",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """The whole history from a change log in one batch.

    An event starts a version when a check column or the deleted state differs from the event
    before; a delete only ends the version before it. ``order`` must be total within a key.
    """
    flagged = log.withColumn("_deleted", F.col(op) == "d")
    state = [*check_cols, "_deleted"]
    placed = place(flagged, keys, order, rows_per_segment)
    prev = with_previous(placed, keys, order, state, "_before")
    same = F.col("_before").isNotNull()
    for c in state:
        same = same & F.col(c).eqNullSafe(F.col("_before")[c])
    starts = prev.where(~same).drop("_before")
    spans = with_next(starts, keys, order, [at], "_after")
    return spans.where(~F.col("_deleted")).select(
        *keys, *check_cols, F.col(at).alias("valid_from"), F.col("_after")[at].alias("valid_to")
    )
