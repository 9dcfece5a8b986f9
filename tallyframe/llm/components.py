"""Connected components of a large graph by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import store

# rounds that tie a node to its smallest neighbour, which settles stars; later ones go by hash, which halves chains
PLAIN_ROUNDS = 2


def _smallest(node: str, other: str, turn: int) -> Column:
    """The first of a node and all its neighbours, by value or by a hash of the round."""
    if turn < PLAIN_ROUNDS:
        return F.least(F.first(node), F.min(other))
    rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("n"))
    return F.least(F.min(rank(node)), F.min(rank(other)))["n"]


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the smallest node that can be reached.

    Each round ties every node to one of its neighbours or itself and replaces the ends of all edges by what they are
    tied to; edges within one node fall away. Every table is stored before the next step joins it, so that rows of a
    hub can be split over tasks, and a lost executor costs one step.
    """
    now = store(
        edges.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        label,
    )
    ties: list[DataFrame] = []
    while now.limit(1).count():
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        tie = store(both.groupBy("u").agg(_smallest("u", "v", len(ties)).alias("to")), f"{label}-ties")
        ties.append(tie)
        ends = now.join(tie.select(F.col("u").alias("a"), F.col("to").alias("x")), "a").join(
            tie.select(F.col("u").alias("b"), F.col("to").alias("y")), "b"
        )
        now = store(
            ends.where(F.col("x") != F.col("y")).select(
                F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")
            ).distinct(),
            label,
        )
    if not ties:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = ties[0].select(F.col("u").alias("node"), F.col("to").alias("end"))
    for tie in ties[1:]:
        found = found.join(tie.select(F.col("u").alias("end"), F.col("to").alias("next")), "end", "left").select(
            "node", F.coalesce("next", "end").alias("end")
        )
    if len(ties) <= PLAIN_ROUNDS:
        # only ties to smaller nodes: the end is the smallest
        return found.select("node", F.col("end").alias("root"))
    found = store(found, f"{label}-ends")
    least = found.groupBy("end").agg(F.min("node").alias("root"))
    return found.join(least, "end").select("node", "root")
