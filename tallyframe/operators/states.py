"""Aggregate states that are stored per period and merged when they are read.

A state row holds what a period's facts come to: their number, exact sums, a HyperLogLog sketch per distinct count, a Theta sketch
where sets of periods are compared, and a KLL sketch per quantile. States of any periods merge, so a total over years reads
a row per period and key instead of the facts, and one period is replaced as a whole when its facts change.
Sketches have a fixed size: 2^lg_config registers, ``nominal`` hashes, ``k`` levels of values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sinks import read_table

# 2^14 registers: a relative standard error of 0.8 %
LG_CONFIG = 14
# rank error of about 0.1 % with 99 % confidence
KLL_K = 2048


def hll_bound(lg_config: int = LG_CONFIG, errors: float = 4.0) -> float:
    """Relative error that an estimate stays below, in standard errors of the merged sketch."""
    return errors * 1.04 / (2 ** (lg_config / 2))


def kll_bound(k: int = KLL_K) -> float:
    """Rank error that a quantile stays below with 99 % confidence (published fit of the sketch's normalised rank error)."""
    return 2.446 / k**0.9433


@dataclass(frozen=True)
class StateSpec:
    """Which states a table keeps: ``{name: column}`` per kind. ``keys`` and the period identify a row."""

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    members: Mapping[str, str] = field(default_factory=dict)
    quantiles: Mapping[str, str] = field(default_factory=dict)
    lg_config: int = LG_CONFIG
    kll_k: int = KLL_K


def build_states(facts: DataFrame, period: Column, spec: StateSpec) -> DataFrame:
    """One state row per period and key, in one aggregate with partial sums and sketches on the map side."""
    k = F.lit(spec.kll_k)
    return facts.groupBy(period.alias("period"), *spec.keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(c).cast("decimal(38,2)").alias(f"sum_{n}") for n, c in spec.sums.items()],
        *[F.hll_sketch_agg(c, spec.lg_config).alias(f"hll_{n}") for n, c in spec.distinct.items()],
        *[F.theta_sketch_agg(c).alias(f"theta_{n}") for n, c in spec.members.items()],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"kll_{n}") for n, c in spec.quantiles.items()],
    )


def replace_periods(states: DataFrame, path: str) -> None:
    """Write the given periods in place of what the table has of them; other periods stay untouched.

    A period is one partition and is written whole, so a run that is repeated replaces itself.
    """
    states.hint("rebalance", "period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def read_states(spark: SparkSession, path: str, period_type: str = "string") -> DataFrame | None:
    found = read_table(spark, path)
    return None if found is None else found.withColumn("period", F.col("period").cast(period_type))


def merge_states(states: DataFrame, spec: StateSpec, by: Sequence[str] | None = None) -> DataFrame:
    """States of several periods (and keys, with fewer ``by``) as one state per group. The result merges again."""
    by = list(spec.keys if by is None else by)
    return states.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        *[F.sum(f"sum_{n}").cast("decimal(38,2)").alias(f"sum_{n}") for n in spec.sums],
        *[F.hll_union_agg(f"hll_{n}").alias(f"hll_{n}") for n in spec.distinct],
        *[F.theta_union_agg(f"theta_{n}").alias(f"theta_{n}") for n in spec.members],
        *[F.kll_merge_agg_double(f"kll_{n}", spec.kll_k).alias(f"kll_{n}") for n in spec.quantiles],
    )


def answers(states: DataFrame, spec: StateSpec, probs: Mapping[str, float] | None = None) -> DataFrame:
    """Sums, estimates and quantiles that state rows stand for, in place of the sketches."""
    kept = [c for c in states.columns if not c.startswith(("hll_", "theta_", "kll_"))]
    return states.select(
        *kept,
        *[F.hll_sketch_estimate(f"hll_{n}").alias(n) for n in spec.distinct],
        *[F.theta_sketch_estimate(f"theta_{n}").alias(n) for n in spec.members],
        *[
            # a sketch without a value has no quantile
            F.when(F.kll_sketch_get_n_double(f"kll_{n}") > 0, F.kll_sketch_get_quantile_double(f"kll_{n}", F.lit(float(q)))).alias(f"{n}_{p}")
            for n in spec.quantiles for p, q in (probs or {}).items()
        ],
    )


def retained(states: DataFrame, spec: StateSpec, name: str, before: Column, after: Column) -> DataFrame:
    """Per key the members of the periods ``before``, of the periods ``after`` and of both, from two unions of states."""
    theta = F.col(f"theta_{name}")
    sides = states.groupBy(*spec.keys).agg(
        F.theta_union_agg(F.when(before, theta)).alias("_b"), F.theta_union_agg(F.when(after, theta)).alias("_a")
    )
    return sides.select(
        *spec.keys, F.theta_sketch_estimate("_b").alias("members_before"), F.theta_sketch_estimate("_a").alias("members_after"),
        F.theta_sketch_estimate(F.theta_intersection("_b", "_a")).alias("members_both"),
    )
