"""Set comparisons with a label for the side a row came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_counts(frames: dict[str, DataFrame], label: str = "layer") -> DataFrame:
    """UNION ALL of one row count per frame."""
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def except_both_ways(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """Rows only in one side, as sets or with multiplicity, in one grouped pass.

    Both sides are counted per distinct row in a single shuffle instead of two EXCEPTs.
    """
    cols = a.columns
    tagged = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    counts = tagged.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    surplus = F.col("_a") - F.col("_b")
    if not multiset:
        side = F.when((F.col("_a") > 0) & (F.col("_b") == 0), "a_minus_b").when(
            (F.col("_a") == 0) & (F.col("_b") > 0), "b_minus_a"
        )
        return counts.withColumn("which_diff", side).where("which_diff is not null").select("which_diff", *cols)
    side = F.when(surplus > 0, "a_minus_b").when(surplus < 0, "b_minus_a")
    return counts.withColumn("which_diff", side).where("which_diff is not null").select(
        "which_diff", *cols, F.abs(surplus).alias("n_rows")
    )


def intersect_names(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """Names in both lists, in the order of the first."""
    return [x for x in a if x in set(b)]
