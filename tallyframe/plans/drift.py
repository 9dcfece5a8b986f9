"""Feature drift between a baseline and a current snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.quantiles import exact_quantiles
from tallyframe.operators.states import KLL_K, kll_bound
from tallyframe.operators.tables import unpivot
from tallyframe.plans.features import FEATURE_NAMES

# Fixed value: a feature counts as drifted above this many interquartile ranges.
DRIFT_THRESHOLD = 3.0


def _long(features: DataFrame, names: Sequence[str]) -> DataFrame:
    return unpivot(features.select(*names), [], names, "double", "feature_name", "value")


def feature_quartiles(features: DataFrame, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """q1, median and q3 of every feature in one job."""
    return exact_quantiles(
        _long(features, names), "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["feature_name"]
    )


def drift_scores(
    baseline: DataFrame,
    current: DataFrame,
    measured_at: Column,
    threshold: float = DRIFT_THRESHOLD,
    names: Sequence[str] = FEATURE_NAMES,
) -> DataFrame:
    """Shift of the median in interquartile ranges of the baseline, with the flag."""
    sides = _long(baseline, names).withColumn("_side", F.lit("b")).unionByName(
        _long(current, names).withColumn("_side", F.lit("c"))
    )
    quartiles = exact_quantiles(
        sides, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["_side", "feature_name"]
    )
    base, cur = F.col("_side") == "b", F.col("_side") == "c"
    per_feature = quartiles.groupBy("feature_name").agg(
        F.max(F.when(base, F.col("median"))).alias("baseline_median"),
        F.max(F.when(base, F.col("q3") - F.col("q1"))).alias("_iqr"),
        F.max(F.when(cur, F.col("median"))).alias("current_median"),
    )
    shift = F.abs(F.col("current_median") - F.col("baseline_median"))
    score = F.coalesce(F.try_divide(shift, F.col("_iqr")), F.lit(0.0))
    return per_feature.where("baseline_median is not null and current_median is not null").select(
        "feature_name", score.alias("drift_score"),
        F.when(score > threshold, 1).otherwise(0).alias("is_drifted"),
        "baseline_median", "current_median", measured_at.alias("measured_at"),
    )


def psi(
    baseline: DataFrame, current: DataFrame, bins: int = 10, names: Sequence[str] = FEATURE_NAMES
) -> DataFrame:
    """Population stability index over the baseline's quantile bins.

    Both sides are reduced to counts per (feature, value) before a value meets the bin edges, and
    the edges are one small array per feature.
    """
    probs = {f"p{i}": i / bins for i in range(1, bins)}
    long_b, long_c = _long(baseline, names), _long(current, names)
    edges = exact_quantiles(long_b, "value", probs, ["feature_name"]).select(
        "feature_name", F.array_distinct(F.array(*probs)).alias("_edges")
    )
    values = (
        long_b.withColumns({"_b": F.lit(1), "_c": F.lit(0)})
        .unionByName(long_c.withColumns({"_b": F.lit(0), "_c": F.lit(1)}))
        .where("value is not null")
        .groupBy("feature_name", "value")
        .agg(F.sum("_b").alias("_b"), F.sum("_c").alias("_c"))
    )
    # one row per feature name, a fixed list
    binned = values.join(F.broadcast(edges), "feature_name").withColumn(
        "_bin", F.size(F.filter("_edges", lambda e: e < F.col("value")))
    )
    per_bin = binned.groupBy("feature_name", "_bin").agg(F.sum("_b").alias("_b"), F.sum("_c").alias("_c"))
    totals = per_bin.groupBy("feature_name").agg(F.sum("_b").alias("_nb"), F.sum("_c").alias("_nc"))
    # Fixed value: share given to an empty bin so that the logarithm exists.
    floor = F.lit(0.0001)
    p = F.greatest(F.try_divide(F.col("_c").cast("double"), F.col("_nc")), floor)
    q = F.greatest(F.try_divide(F.col("_b").cast("double"), F.col("_nb")), floor)
    return (
        per_bin.join(F.broadcast(totals), "feature_name")
        .groupBy("feature_name")
        .agg(F.sum((p - q) * F.ln(p / q)).alias("psi"), F.count(F.lit(1)).alias("bins"))
    )


# The share given to an empty bin, as in psi.
_EMPTY = 0.0001


# points of the quantile curve that a sketch is read at
GRID = 1000


def share_bound(k: int = KLL_K) -> float:
    """Error that a bin's share from sketches stays below: the rank errors of its two edges."""
    return 2 * (kll_bound(k) + 1 / GRID)


def feature_sketches(features: DataFrame, names: Sequence[str] = FEATURE_NAMES, k: int = KLL_K) -> DataFrame:
    """``snapshot_ts, feature_name, rows, sketch``: a KLL sketch of every feature of every snapshot, a few kilobytes each.

    Written once per snapshot, it stands for the snapshot's rows in all later comparisons.
    """
    # a row updates the sketches of all features of its snapshot: one group per snapshot, and no row per feature
    sketch = lambda n: F.when(F.count(n) > 0, F.struct(
        F.lit(n).alias("feature_name"), F.count(n).alias("rows"), F.kll_sketch_agg_double(F.col(n).cast("double"), F.lit(k)).alias("sketch")
    ))
    per_snapshot = features.groupBy("snapshot_ts").agg(F.array(*[sketch(n) for n in names]).alias("_s"))
    return per_snapshot.select("snapshot_ts", F.inline(F.array_compact("_s")))


def psi_from_sketches(baseline: DataFrame, current: DataFrame, bins: int = 10, k: int = KLL_K) -> DataFrame:
    """Population stability index from stored sketches; neither side's rows are read.

    Sketches of several snapshots per side merge first. ``edges`` are the baseline's quantiles, ``shares_baseline`` and
    ``shares_current`` the shares of the bins; each is within :func:`share_bound` of the exact one.
    """
    merged = lambda df, c: df.groupBy("feature_name").agg(F.kll_merge_agg_double("sketch", k).alias(c))
    curve = lambda side: F.kll_sketch_get_quantile_double(side, F.array(*[F.lit(i / GRID) for i in range(1, GRID + 1)]))
    both = merged(baseline, "_b").join(merged(current, "_c"), "feature_name").select(
        "feature_name", curve("_b").alias("_qb"), curve("_c").alias("_qc"),
        F.array_distinct(F.kll_sketch_get_quantile_double("_b", F.array(*[F.lit(i / bins) for i in range(1, bins)]))).alias("edges"),
    )
    # the share up to an edge is how far the quantile curve stays at or below it; an edge belongs to the bin below it
    upto = lambda side: F.transform("edges", lambda e: F.size(F.filter(side, lambda x: x <= e)) / F.lit(float(GRID)))
    upto = both.withColumns({
        "_rb": F.concat(F.array(F.lit(0.0)), upto("_qb"), F.array(F.lit(1.0))),
        "_rc": F.concat(F.array(F.lit(0.0)), upto("_qc"), F.array(F.lit(1.0))),
    })
    share = lambda ranks: F.zip_with(F.slice(ranks, 2, F.size(ranks) - 1), F.slice(ranks, 1, F.size(ranks) - 1), lambda b, a: b - a)
    shares = upto.withColumns({"shares_baseline": share(F.col("_rb")), "shares_current": share(F.col("_rc"))})
    term = F.zip_with("shares_current", "shares_baseline", lambda c, b: (F.greatest(c, F.lit(_EMPTY)) - F.greatest(b, F.lit(_EMPTY))) * F.ln(
        F.greatest(c, F.lit(_EMPTY)) / F.greatest(b, F.lit(_EMPTY))))
    # bins that neither side fills do not count
    kept = F.zip_with("shares_current", "shares_baseline", lambda c, b: (c > 0) | (b > 0))
    psi_terms = F.zip_with(term, kept, lambda t, k: F.when(k, t).otherwise(F.lit(0.0)))
    return shares.select(
        "feature_name", F.aggregate(psi_terms, F.lit(0.0), lambda acc, t: acc + t).alias("psi"), "edges", "shares_baseline", "shares_current"
    )


def latest_drift(metrics: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """The newest measurement set with a status per feature."""
    newest = metrics.agg(F.max("measured_at").alias("m")).scalar()
    return metrics.where(F.col("measured_at") == newest).withColumn(
        "status", F.when(F.col("drift_score") > threshold, "EXCEEDED").otherwise("OK")
    )
