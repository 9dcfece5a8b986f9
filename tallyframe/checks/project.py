"""Quality checks of the payments tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.checks.runner import TableChecks, result_row, union_results
from tallyframe.functions.calendar import date_diff
from tallyframe.plans.features import FEATURE_NAMES, RATE_FEATURES, valid_row

# Value domains of the silver tables.
DOMAINS = {
    "transaction_status": ["approved", "declined", "pending", "cancelled"],
    "repayment_status": ["paid", "overdue", "waived", "pending"],
    "kyc_status": ["approved", "pending", "rejected"],
    "credit_tier": ["standard", "premium", "vip"],
    "risk_tier": ["low", "medium", "high"],
    "schedule_status": ["active", "completed", "defaulted"],
}

SILVER_CHECKS = [
    TableChecks(
        "transactions",
        not_null=["transaction_id", "user_id", "merchant_id", "amount", "currency", "created_at"],
        accepted_values={"status": DOMAINS["transaction_status"]},
        relationships={"user_id": ("users", "user_id"), "merchant_id": ("merchants", "merchant_id")},
    ),
    TableChecks(
        "repayments",
        not_null=["repayment_id", "transaction_id", "user_id", "amount"],
        accepted_values={"status": DOMAINS["repayment_status"]},
        relationships={"transaction_id": ("transactions", "transaction_id"), "user_id": ("users", "user_id")},
    ),
    TableChecks(
        "users",
        not_null=["user_id", "email", "credit_limit"],
        accepted_values={"kyc_status": DOMAINS["kyc_status"], "credit_tier": DOMAINS["credit_tier"]},
    ),
    TableChecks(
        "merchants",
        not_null=["merchant_id", "merchant_name", "merchant_category"],
        accepted_values={"risk_tier": DOMAINS["risk_tier"]},
    ),
    TableChecks(
        "installments",
        not_null=["schedule_id"],
        accepted_values={"status": DOMAINS["schedule_status"]},
        relationships={"transaction_id": ("transactions", "transaction_id")},
    ),
]


# -- gate of the feature job: one aggregate for all of it ------------------------------------------

def null_counts(features: DataFrame) -> DataFrame:
    wide = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURE_NAMES])
    return wide.unpivot([], FEATURE_NAMES, "feature_name", "null_rows")


def feature_gate(features: DataFrame) -> DataFrame:
    """NULLs, velocity order, rate range and validity of a feature run, with one verdict."""
    any_null = ~F.lit(True)
    for c in FEATURE_NAMES:
        any_null = any_null | F.col(c).isNull()
    rate = F.col("repayment_rate_90d")
    out = features.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(any_null).alias("null_rows"),
        F.count_if(F.col("tx_velocity_30d") < F.col("tx_velocity_7d")).alias("velocity_rows"),
        F.count_if((rate < 0) | (rate > 1)).alias("rate_rows"),
        F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("validity_rows"),
    )
    failed = F.col("null_rows") + F.col("velocity_rows") + F.col("rate_rows") + F.col("validity_rows")
    return out.withColumn("passed", failed == 0)


def split_valid(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may be served, and the rejects."""
    return features.where(valid_row()), features.where(~valid_row())


def validate_features(features: DataFrame, check_time: Column) -> DataFrame:
    """Four result rows over all features, measured in one scan."""
    missing = ~F.lit(True)
    negative = ~F.lit(True)
    for c in FEATURE_NAMES:
        missing = missing | F.col(c).isNull()
        negative = negative | F.coalesce(F.col(c) < 0, F.lit(False))
    off = ~F.lit(True)
    for c in RATE_FEATURES:
        off = off | F.coalesce((F.col(c) < 0) | (F.col(c) > 1), F.lit(False))
    misordered = F.col("tx_velocity_30d") < F.col("tx_velocity_7d")
    m = features.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("missing"),
        F.count_if(negative).alias("negative"), F.count_if(off).alias("off"),
        F.count_if(misordered).alias("misordered"),
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("check_name"), F.lit(kind).alias("check_type"),
                    F.when(F.col(c) == 0, "pass").otherwise(bad).alias("status"), F.col(c).alias("rows_failed"),
                )
                for name, kind, c, bad in [
                    ("null_check", "completeness", "missing", "fail"),
                    ("range_check_non_negative", "validity", "negative", "warn"),
                    ("range_check_rates", "validity", "off", "warn"),
                    ("velocity_ordering", "consistency", "misordered", "warn"),
                ]
            ]
        )
    )
    return m.select("total", rows).select(
        check_time.alias("check_time"), F.lit("feature_store").alias("stage"), "check_name", "check_type",
        "status", F.to_json(F.struct("rows_failed")).alias("details"),
        F.col("total").alias("rows_checked"), "rows_failed",
    )


# -- layer checks ---------------------------------------------------------------------------------------

def silver_gate(tx: DataFrame, repay: DataFrame) -> DataFrame:
    a = tx.agg(F.count_if(F.col("amount") < 0).alias("n")).select(F.lit("negative_amounts").alias("check_name"), "n")
    known = F.coalesce(F.col("status").isin(DOMAINS["repayment_status"]), F.lit(True))
    b = repay.agg(F.count_if(~known).alias("n")).select(F.lit("unknown_repayment_status").alias("check_name"), "n")
    return a.unionByName(b).select("check_name", F.col("n").alias("rows_failed"), (F.col("n") == 0).alias("passed"))


def coverage_status(share: Column) -> Column:
    # Coverage that passes, and that still only warns.
    return F.when(share >= 0.95, "pass").when(share >= 0.80, "warn").otherwise("fail")


def _coverage(users: DataFrame, features: DataFrame, distinct: Column) -> tuple[DataFrame, Column]:
    have = features.agg(distinct.alias("n")).scalar()
    m = users.agg(F.count(F.lit(1)).alias("silver_users")).withColumn("feature_users", have)
    share = F.coalesce(F.try_divide(F.col("feature_users").cast("double"), F.col("silver_users")), F.lit(0.0))
    return m.withColumn("coverage", F.round(share, 4)), share


def feature_completeness(users: DataFrame, features: DataFrame, check_time: Column) -> DataFrame:
    m, share = _coverage(users, features, F.count_distinct("user_id"))
    return result_row(
        m, check_time, "feature_store", "completeness_check", "completeness",
        F.col("silver_users"), F.col("silver_users") - F.col("feature_users"), coverage_status(share),
        ["silver_users", "feature_users", "coverage"],
    )


def gold_feature_reconciliation(
    users: DataFrame, features: DataFrame, check_time: Column, exact: bool = False
) -> DataFrame:
    distinct = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id", 0.01)
    m, share = _coverage(users, features, distinct)
    return result_row(
        m, check_time, "gold", "gold_feature_reconciliation", "reconciliation",
        F.col("silver_users"), F.abs(F.col("silver_users") - F.col("feature_users")), coverage_status(share),
        ["silver_users", "feature_users", "coverage"],
    )


def feature_nulls(features: DataFrame, check_time: Column) -> DataFrame:
    missing = ~F.lit(True)
    for c in FEATURE_NAMES:
        missing = missing | F.col(c).isNull()
    m = features.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(missing).alias("null_rows"))
    return result_row(
        m, check_time, "feature_store", "null_check", "completeness", F.col("total_rows"), F.col("null_rows"),
        details=["null_rows", "total_rows"],
    )


def gold_completeness(marts: dict[str, tuple[DataFrame, int]], check_time: Column) -> DataFrame:
    """One result row over the row minimums of ``{mart: (frame, minimum)}``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("mart"), "rows", F.lit(least).alias("min_expected"), (F.col("rows") >= least).alias("ok")
        )
        for n, (df, least) in marts.items()
    ]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    m = counts.agg(F.sum("rows").alias("rows"), F.count_if(~F.col("ok")).alias("short"))
    return result_row(
        m, check_time, "gold", "gold_completeness_check", "completeness", F.col("rows"), F.col("short"),
        details=["rows", "short"],
    )


def source_freshness(
    tables: dict[str, tuple[DataFrame, str]], as_of: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest row per table and its status."""
    parts = []
    for name, (df, column) in tables.items():
        age = date_diff("second", F.col("newest"), as_of) / 3600
        parts.append(
            df.agg(F.max(column).alias("newest")).select(
                F.lit(name).alias("table_name"), "newest",
                F.when(F.col("newest").isNull() | (age > error_hours), "error")
                .when(age > warn_hours, "warn").otherwise("pass").alias("status"),
            )
        )
    return union_results(parts)


# -- single rules -----------------------------------------------------------------------------------------

def version_consistency(features: DataFrame) -> DataFrame:
    """Snapshots of a user that mix feature versions."""
    return (
        features.groupBy("user_id", "snapshot_ts")
        .agg(F.count_distinct("feature_version").alias("version_count"))
        .where("version_count > 1")
    )


def approved_above_limit(tx: DataFrame, users: DataFrame, factor: float = 2.0) -> DataFrame:
    approved = tx.where(F.col("status") == "approved").select("transaction_id", "user_id", "amount")
    limits = users.select("user_id", "credit_limit")
    return approved.join(limits, "user_id").where(
        F.col("amount").cast("double") > F.col("credit_limit").cast("double") * factor
    ).select("transaction_id", "user_id", "amount", "credit_limit")


def merchant_completeness(kpis: DataFrame, minimum: int = 200) -> DataFrame:
    return kpis.agg(F.count_distinct("merchant_id").alias("merchants")).where(F.col("merchants") < minimum)


def settlement_variance(recon: DataFrame, limit: float = 100) -> DataFrame:
    return recon.where(F.abs("variance_pct") > limit)


def cohort_repaid_not_zero(cohorts: DataFrame) -> DataFrame:
    """One row when every user's repaid total is zero."""
    return cohorts.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("total_repaid") == 0).alias("zero_rows")
    ).where("total > 0 and total = zero_rows")


def no_negative_amounts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def rate_in_range(df: DataFrame, column: str) -> DataFrame:
    return df.where((F.col(column) < 0) | (F.col(column) > 1))


def layer_acceptance(minimums: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("layer"), "row_count", F.lit(m).alias("minimum"), (F.col("row_count") >= m).alias("passed")
        )
        for n, df, m in minimums
    ]
    return union_results(parts)
