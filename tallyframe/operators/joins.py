"""Join shapes that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def left_join_many(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT JOIN where the hot key may sit on the right side.

    The adaptive skew join cannot split the right side of a left join, but it splits both sides of an
    inner one. So matches come from an inner join and the rest from an anti join against the distinct
    keys of the right side, which are one row per key and task before they travel.
    """
    names = list(keys)
    matched = left.join(right, names, "inner")
    unmatched = left.join(right.select(*names).distinct(), names, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
