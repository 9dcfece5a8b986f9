"""Enriched facts and daily marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.calendar import date_diff
from tallyframe.functions.scalars import share
from tallyframe.operators.joins import left_join_many

MONEY = "decimal(15,2)"


def _money(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast(MONEY)


# -- joins -----------------------------------------------------------------------------------

def transaction_enriched(tx: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Each transaction with the attributes of its user and merchant.

    Both dimensions grow with the business, so neither is forced to broadcast: the size check of
    the optimizer decides, and a hot merchant or user is split by the adaptive skew join.
    """
    u = users.select(
        "user_id",
        F.col("credit_tier").alias("user_credit_tier"),
        F.col("credit_limit").alias("user_credit_limit"),
        F.col("kyc_status").alias("user_kyc_status"),
    )
    m = merchants.select(
        "merchant_id", "merchant_name", "merchant_category",
        F.col("risk_tier").alias("merchant_risk_tier"),
        F.col("commission_rate").alias("merchant_commission_rate"),
    )
    return tx.join(u, "user_id", "left").join(m, "merchant_id", "left").select(
        *tx.columns,
        "user_credit_tier", "user_credit_limit", "user_kyc_status",
        "merchant_name", "merchant_category", "merchant_risk_tier", "merchant_commission_rate",
    )


def repayment_timeline(repay: DataFrame, tx: DataFrame, as_of: Column) -> DataFrame:
    """Each repayment with its transaction and the days between due date and payment (or today)."""
    t = tx.select(
        "transaction_id",
        F.col("amount").alias("transaction_amount"),
        F.col("status").alias("transaction_status"),
        "merchant_id",
    )
    paid_on = F.coalesce(F.to_date("paid_at"), F.to_date(as_of))
    return repay.join(t, "transaction_id", "left").select(
        "repayment_id", "transaction_id", "user_id", "installment_number",
        F.col("amount").alias("repayment_amount"), "due_date", "paid_at",
        F.col("status").alias("repayment_status"),
        "transaction_amount", "transaction_status", "merchant_id",
        F.datediff(paid_on, F.col("due_date")).alias("days_from_due"),
    )


def user_credit_history(tx: DataFrame, repay: DataFrame) -> DataFrame:
    """Every transaction with all its repayments; one transaction may have very many."""
    r = repay.select(
        "transaction_id", "repayment_id",
        F.col("amount").alias("repayment_amount"),
        F.col("status").alias("repayment_status"),
        "due_date", "paid_at",
    )
    t = tx.select(
        "user_id", "transaction_id", F.col("amount").alias("tx_amount"),
        F.col("status").alias("tx_status"), "merchant_id", F.col("created_at").alias("tx_date"),
    )
    return left_join_many(t, r, ["transaction_id"]).select(
        *t.columns, "repayment_id", "repayment_amount", "repayment_status", "due_date", "paid_at",
    )


# -- marts -----------------------------------------------------------------------------------

def _rates(df: DataFrame) -> DataFrame:
    """Rates of a KPI row from its additive columns."""
    n = F.col("transaction_count")
    return df.withColumns({
        "approval_rate": F.coalesce(F.try_divide(F.col("approved_count").cast("double"), n), F.lit(0.0)),
        "avg_basket_size": F.coalesce(F.try_divide(F.col("gmv"), n), F.lit(0)).cast("decimal(12,4)"),
        "bnpl_penetration": F.coalesce(F.try_divide(F.col("instalment_count").cast("double"), n), F.lit(0.0)),
    })


KPI_COLUMNS = [
    "merchant_id", "merchant_category", "date", "gmv", "transaction_count", "approved_count",
    "declined_count", "approval_rate", "avg_basket_size", "bnpl_penetration",
]


def merchant_daily_kpis(tx: DataFrame, merchants: DataFrame) -> DataFrame:
    """Daily KPIs per merchant and category.

    Facts are reduced to one row per (merchant, day) with partial sums before the merchant's
    category is looked up, so the join sees the mart's size and not the fact's, and a hot merchant
    is a handful of rows per task.
    """
    daily = tx.groupBy("merchant_id", F.to_date("created_at").alias("date")).agg(
        F.sum("amount").cast(MONEY).alias("gmv"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("status") == "approved").alias("approved_count"),
        F.count_if(F.col("status") == "declined").alias("declined_count"),
        F.count_if(F.col("installment_count") > 1).alias("instalment_count"),
    )
    named = daily.join(merchants.select("merchant_id", "merchant_category"), "merchant_id", "left")
    return _rates(named).select(*KPI_COLUMNS)


def user_cohorts(tx: DataFrame, repay: DataFrame | None = None) -> DataFrame:
    """Per user: first month, lifetime value, month span and repeat rate.

    ``total_repaid`` is 0 as in the original mart; with ``repay`` given the paid sum is added as
    ``total_repaid_actual``.
    """
    n = F.col("total_transactions")
    first, last = F.col("_first"), F.col("_last")
    out = (
        tx.groupBy("user_id")
        .agg(
            F.min("created_at").alias("_first"),
            F.max("created_at").alias("_last"),
            F.sum("amount").cast(MONEY).alias("ltv"),
            F.count(F.lit(1)).alias("total_transactions"),
        )
        .select(
            F.trunc(first, "month").alias("cohort_month"), "user_id", "ltv", "total_transactions",
            F.lit(0).cast("decimal(12,2)").alias("total_repaid"),
            date_diff("month", first, last).alias("retention_months"),
            F.when(n > 1, (n - 1).cast("double") / n).otherwise(0.0).alias("reorder_rate"),
        )
    )
    if repay is None:
        return out
    paid = (
        repay.where(F.col("status") == "paid")
        .groupBy("user_id")
        .agg(F.sum("amount").cast(MONEY).alias("_paid"))
    )
    return out.join(paid, "user_id", "left").withColumn("total_repaid_actual", _money(F.col("_paid"))).drop("_paid")


def expected_settlements(tx: DataFrame) -> DataFrame:
    approved = F.when(F.col("status") == "approved", F.col("amount"))
    return tx.groupBy(F.to_date("created_at").alias("settlement_date"), "merchant_id").agg(
        F.coalesce(F.sum(approved), F.lit(0)).cast(MONEY).alias("expected_amount")
    )


def actual_settlements(repay: DataFrame, tx: DataFrame) -> DataFrame:
    """Paid repayments by payment day and merchant of their transaction.

    Only paid rows and three columns reach the join.
    """
    paid = repay.where((F.col("status") == "paid") & F.col("paid_at").isNotNull()).select(
        "transaction_id", "amount", F.to_date("paid_at").alias("settlement_date")
    )
    return (
        paid.join(tx.select("transaction_id", "merchant_id"), "transaction_id", "left")
        .groupBy("settlement_date", "merchant_id")
        .agg(F.sum("amount").cast(MONEY).alias("actual_amount"))
    )


def settlement_reconciliation(tx: DataFrame, repay: DataFrame) -> DataFrame:
    """Expected against actual money per day and merchant. ``variance_pct`` is a fraction."""
    expected, actual = expected_settlements(tx), actual_settlements(repay, tx)
    joined = expected.join(actual, ["settlement_date", "merchant_id"], "left")
    got = _money(F.col("actual_amount"))
    variance = (F.col("expected_amount") - got).cast(MONEY)
    return joined.select(
        "settlement_date", "merchant_id", "expected_amount",
        got.alias("actual_amount"), variance.alias("variance"),
        F.when(F.col("expected_amount") > 0, variance.cast("double") / F.col("expected_amount").cast("double"))
        .otherwise(0.0).alias("variance_pct"),
        F.when(F.abs(variance) < 0.01, "matched")
        .when(F.col("actual_amount").isNull(), "pending")
        .otherwise("mismatch").alias("status"),
    )


def settlement_daily(tx: DataFrame, actual: DataFrame, as_of: Column) -> DataFrame:
    """The scheduled variant: yesterday's approved money per merchant against ``actual``.

    ``actual`` has ``merchant_id, actual_amount``. ``variance_pct`` is in percent here.
    """
    day = F.date_sub(F.to_date(as_of), 1)
    expected = (
        tx.where((F.col("created_at") >= day) & (F.col("created_at") < F.date_add(day, 1)))
        .where(F.col("status") == "approved")
        .groupBy("merchant_id")
        .agg(F.sum("amount").cast(MONEY).alias("expected_amount"), F.count(F.lit(1)).alias("transaction_count"))
    )
    got = _money(F.col("actual_amount"))
    joined = expected.join(actual.select("merchant_id", "actual_amount"), "merchant_id", "left")
    variance = (F.col("expected_amount") - got).cast(MONEY)
    pct = F.coalesce(
        F.try_divide(F.abs(variance).cast("double"), F.col("expected_amount").cast("double")) * 100, F.lit(0.0)
    )
    return joined.select(
        F.to_date(as_of).alias("settlement_date"), "merchant_id", "expected_amount", "transaction_count",
        got.alias("actual_amount"), variance.alias("variance"), pct.alias("variance_pct"),
        F.when(pct <= 0.1, "matched").otherwise("mismatch").alias("status"),
    )


def risk_dashboard(tx: DataFrame, repay: DataFrame) -> DataFrame:
    """Daily approval, decline and overdue rates, latency and approved exposure."""
    approved = F.when(F.col("status") == "approved", F.col("amount"))
    daily = tx.groupBy(F.to_date("created_at").alias("date")).agg(
        share(F.col("status") == "approved").alias("approval_rate"),
        share(F.col("status") == "declined").alias("decline_rate"),
        F.avg("decision_latency_ms").alias("avg_decision_latency_ms"),
        F.lit(0).cast("bigint").alias("fraud_flag_count"),
        F.coalesce(F.sum(approved), F.lit(0)).cast("decimal(18,2)").alias("total_exposure"),
    )
    overdue = repay.groupBy(F.col("due_date").alias("date")).agg(
        share(F.col("status") == "overdue").alias("overdue_rate")
    )
    return daily.join(overdue, "date", "left").withColumn(
        "overdue_rate", F.coalesce("overdue_rate", F.lit(0.0))
    )


# -- aggregates over facts and marts ------------------------------------------------------------

def exposure_partials(tx: DataFrame, batch: Column) -> DataFrame:
    """Partial state: approved money per user and batch, to be merged by :func:`merge_exposure`."""
    return (
        tx.where(F.col("status") == "approved")
        .groupBy("user_id", batch.alias("batch"))
        .agg(F.sum("amount").cast("decimal(38,2)").alias("active_exposure"))
    )


def merge_exposure(partials: DataFrame) -> DataFrame:
    return partials.groupBy("user_id").agg(
        F.sum("active_exposure").cast("decimal(38,2)").alias("active_exposure")
    )


def merge_kpi_parts(parts: DataFrame) -> DataFrame:
    """Several partial KPI rows of one key become one: counts add, rates come from the sums."""
    merged = parts.groupBy("merchant_id", "merchant_category", "date").agg(
        *[
            F.sum(c).cast(MONEY if c == "gmv" else "bigint").alias(c)
            for c in ("gmv", "transaction_count", "approved_count", "declined_count", "instalment_count")
        ]
    )
    return _rates(merged).select(*KPI_COLUMNS)


def category_month_rollup(kpis: DataFrame, by_year: bool = False) -> DataFrame:
    """Money and count per category and month; without ``by_year`` the years' months merge."""
    month = F.trunc("date", "month") if by_year else F.month("date")
    return kpis.groupBy("merchant_category", month.alias("month")).agg(
        F.sum("gmv").cast("decimal(25,2)").alias("gmv"),
        F.sum("transaction_count").cast("bigint").alias("transaction_count"),
    )


def cohort_summary(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("users"),
        F.avg(F.col("ltv").cast("double")).alias("avg_ltv"),
        F.avg("retention_months").alias("avg_retention"),
    )


def settlement_summary(recon: DataFrame) -> DataFrame:
    return recon.groupBy("settlement_date").agg(
        F.count_distinct("merchant_id").alias("merchants"),
        F.count_if(F.col("status") == "matched").alias("matched"),
        F.count_if(F.col("status") == "mismatch").alias("mismatches"),
        F.avg("variance_pct").alias("avg_variance_pct"),
    )


def category_risk(tx: DataFrame, merchants: DataFrame, seed: DataFrame) -> DataFrame:
    """Money-weighted risk of each merchant category by the seed's weights.

    Facts reduce to one row per merchant first; the seed is a fixed five-row file.
    """
    per_merchant = tx.groupBy("merchant_id").agg(
        F.sum("amount").alias("gmv"), F.count(F.lit(1)).alias("n")
    )
    return (
        per_merchant.join(merchants.select("merchant_id", "merchant_category"), "merchant_id")
        .groupBy("merchant_category")
        .agg(F.sum("gmv").cast("decimal(25,2)").alias("gmv"), F.sum("n").cast("bigint").alias("transaction_count"))
        .join(F.broadcast(seed), "merchant_category")
        .select(
            "merchant_category", "display_name", "gmv", "transaction_count",
            (F.col("gmv").cast("double") * F.col("risk_weight")).alias("risk_weighted_gmv"),
        )
    )
