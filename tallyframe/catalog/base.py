"""Registry of runnable queries, the tables they share, and the views of their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.plans import features as feat
from tallyframe.plans import marts, staging
from tallyframe.session import finer_shuffles, shared_path, tune
from tallyframe.sources import domain, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The moment that stands for now, after the last order and after the last event of the test tables.
AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
# the feature history has a snapshot every 30 days from the first day of the transactions to the last
SNAPSHOT_DAYS = 30
# validity shorter than the distance of snapshots, so that gaps exist
HISTORY_HOURS = 24 * 20
# stored tables by session and data folder: queries read what another one has written
_STORED: dict[tuple[str, str, str], str] = {}


class Data:
    """Domain tables and marts of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    @cached_property
    def now(self) -> Column:
        return F.lit(AS_OF).cast("timestamp_ntz")

    @cached_property
    def events_now(self) -> Column:
        return F.lit(EVENTS_AS_OF).cast("timestamp_ntz")

    def raw(self, name: str) -> DataFrame:
        return domain.raw(self.spark, self.sf_dir, name)

    @cached_property
    def tx(self) -> DataFrame:
        return domain.transactions(self.spark, self.sf_dir)

    @cached_property
    def stg_tx(self) -> DataFrame:
        return staging.stg_transactions(self.tx)

    @cached_property
    def users(self) -> DataFrame:
        return domain.users(self.spark, self.sf_dir)

    @cached_property
    def merchants(self) -> DataFrame:
        return domain.merchants(self.spark, self.sf_dir)

    @cached_property
    def versions(self) -> DataFrame:
        return domain.repayment_versions(self.spark, self.sf_dir)

    @cached_property
    def repay(self) -> DataFrame:
        return staging.stg_repayments(self.versions, domain.REPAYMENT_KEYS, domain.REPAYMENT_VERSION_ORDER)

    @cached_property
    def silver_repay(self) -> DataFrame:
        """The current repayments as a stored table, for jobs that read them more than once."""
        return self.stored("silver-repayments", lambda: self.repay)

    @cached_property
    def schedules(self) -> DataFrame:
        return domain.installments(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return domain.app_events(self.spark, self.sf_dir)

    @cached_property
    def log(self) -> DataFrame:
        return domain.request_log(self.spark, self.sf_dir)

    @cached_property
    def seed(self) -> DataFrame:
        return tables.read_seed(self.spark, "merchant_categories")

    @cached_property
    def enriched(self) -> DataFrame:
        return marts.transaction_enriched(self.stg_tx, self.users, self.merchants)

    @cached_property
    def kpis(self) -> DataFrame:
        return marts.merchant_daily_kpis(self.stg_tx, self.merchants)

    @cached_property
    def cohorts(self) -> DataFrame:
        return marts.user_cohorts(self.stg_tx)

    @cached_property
    def recon(self) -> DataFrame:
        return marts.settlement_reconciliation(self.stg_tx, self.repay)

    @cached_property
    def risk(self) -> DataFrame:
        return marts.risk_dashboard(self.stg_tx, self.repay)

    @cached_property
    def features(self) -> DataFrame:
        return feat.compute_features(self.stg_tx, self.repay, self.schedules, AS_OF)

    @cached_property
    def computed_history(self) -> DataFrame:
        return feat.compute_feature_history(
            self.stg_tx, self.repay, self.schedules, 24 * SNAPSHOT_DAYS, hours=HISTORY_HOURS
        )

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table computed once per session and data folder, read back by its path."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STORED:
            path = shared_path(self.spark, name)
            build().write.parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])

    @cached_property
    def history(self) -> DataFrame:
        """The feature table as its readers see it: computed once, stored, and read back."""
        # the count reads the footers of the orders only
        with finer_shuffles(self.spark, self.tx.count()):
            return self.stored("feature-history", lambda: self.computed_history)

    @cached_property
    def requests(self) -> DataFrame:
        """Every transaction asks for its user's features; one in fifty gives no time."""
        return self.tx.select(
            F.col("transaction_id").alias("request_id"), "user_id",
            F.when(F.col("transaction_id") % 50 != 0, F.col("created_at")).alias("as_of"),
        )


def finish(df: DataFrame) -> DataFrame:
    """Comparable output: decimals as doubles, doubles to six digits, times without zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(data) -> DataFrame`` with the SQL that must give the same rows."""

    def wrap(fn: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: finish(fn(Data(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return wrap


def add(name: str, fn: Callable[[Data], DataFrame], sql: str | None = None) -> None:
    query(name, sql)(fn)


# -- views of the check SQL -------------------------------------------------------------------------

def _select(mapping: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in mapping.items()) + f" FROM {source}"


_FEATURE_SQL = """
    SELECT t.user_id, s AS snapshot_ts, s AS valid_from, s + INTERVAL '{hours}' HOUR AS valid_to,
      'v1' AS feature_version, t.tx_velocity_7d, t.tx_velocity_30d,
      coalesce(t.avg_amount, 0)::DECIMAL(12,2) AS avg_tx_amount_30d,
      coalesce(r.rate, 0.0)::DOUBLE AS repayment_rate_90d, t.merchant_diversity_30d,
      coalesce(t.declined_rate, 0.0)::DOUBLE AS declined_rate_7d,
      coalesce(i.n, 0) AS active_installments, t.days_since_first_tx
    FROM (SELECT user_id, s,
            count(*) FILTER (created_at >= s - INTERVAL 7 DAY) AS tx_velocity_7d,
            count(*) FILTER (created_at >= s - INTERVAL 30 DAY) AS tx_velocity_30d,
            -- half a cent rounds up, in whole cents: a mean in floating point may fall below the half
            ((200 * sum(amount) FILTER (created_at >= s - INTERVAL 30 DAY))::BIGINT + count(*) FILTER (created_at >= s - INTERVAL 30 DAY))
              // nullif(2 * count(*) FILTER (created_at >= s - INTERVAL 30 DAY), 0) / 100.0 AS avg_amount,
            count(DISTINCT merchant_id) FILTER (created_at >= s - INTERVAL 30 DAY) AS merchant_diversity_30d,
            count(*) FILTER (created_at >= s - INTERVAL 7 DAY AND status = 'declined')::DOUBLE
              / nullif(count(*) FILTER (created_at >= s - INTERVAL 7 DAY), 0) AS declined_rate,
            date_diff('day', min(created_at)::DATE, s::DATE) AS days_since_first_tx
          FROM stg_transactions, {snaps} WHERE created_at <= s GROUP BY user_id, s) t
    LEFT JOIN (SELECT user_id, s, count(*) FILTER (paid_at IS NOT NULL AND paid_at::DATE <= due_date)::DOUBLE
            / count(*) AS rate
          FROM repayments, {snaps}
          WHERE due_date >= s::DATE - 90 AND due_date <= s::DATE GROUP BY user_id, s) r USING (user_id, s)
    LEFT JOIN (SELECT user_id, s, count(*) AS n FROM installments, {snaps}
          WHERE status = 'active' AND created_at <= s GROUP BY user_id, s) i USING (user_id, s)
"""


def _snaps(times: list[str]) -> str:
    return "(SELECT unnest([" + ", ".join(f"TIMESTAMP '{t}'" for t in times) + "]) AS s)"


VIEWS = {
    "transactions": _select(domain.TRANSACTIONS, "orders"),
    "stg_transactions": "SELECT * FROM transactions WHERE status <> 'cancelled'",
    "users": _select(domain.USERS, "customer"),
    "merchants": _select(domain.MERCHANTS, "supplier LEFT JOIN nation ON s_nationkey = n_nationkey"),
    "repayment_versions": _select(
        domain.REPAYMENT_VERSIONS, "lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"
    ),
    "repayments": """SELECT * EXCLUDE (rn) REPLACE (lower(status) AS status) FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id, installment_number
          ORDER BY updated_at DESC, tie_part DESC, tie_supp DESC, amount DESC, tie_qty DESC) AS rn
        FROM repayment_versions) WHERE rn = 1""",
    "installments": _select(domain.INSTALLMENTS, "orders"),
    "app_events": _select(domain.APP_EVENTS, "events"),
    "request_log": _select(domain.REQUEST_LOG, "events"),
    "category_seed": "SELECT * FROM (VALUES ('electronics', 0.8::DOUBLE, 'Electronics'), "
    "('fashion', 0.6, 'Fashion & Apparel'), ('groceries', 0.3, 'Groceries'), "
    "('restaurants', 0.5, 'Restaurants & Food'), ('travel', 0.9, 'Travel & Tourism')) "
    "v(merchant_category, risk_weight, display_name)",
    "tx_enriched": """SELECT t.*, u.credit_tier AS user_credit_tier, u.credit_limit AS user_credit_limit,
        u.kyc_status AS user_kyc_status, m.merchant_name, m.merchant_category,
        m.risk_tier AS merchant_risk_tier, m.commission_rate AS merchant_commission_rate
        FROM stg_transactions t LEFT JOIN users u ON t.user_id = u.user_id
        LEFT JOIN merchants m ON t.merchant_id = m.merchant_id""",
    "kpis": """SELECT merchant_id, merchant_category, created_at::DATE AS date, sum(amount) AS gmv,
        count(*) AS transaction_count, count(*) FILTER (status = 'approved') AS approved_count,
        count(*) FILTER (status = 'declined') AS declined_count,
        count(*) FILTER (status = 'approved')::DOUBLE / count(*) AS approval_rate,
        round(sum(amount)::DOUBLE / count(*), 4) AS avg_basket_size,
        count(*) FILTER (installment_count > 1)::DOUBLE / count(*) AS bnpl_penetration
        FROM tx_enriched GROUP BY ALL""",
    "cohorts": """SELECT date_trunc('month', min(created_at))::DATE AS cohort_month, user_id, sum(amount) AS ltv,
        count(*) AS total_transactions, 0::DECIMAL(12,2) AS total_repaid,
        date_diff('month', min(created_at), max(created_at)) AS retention_months,
        CASE WHEN count(*) > 1 THEN (count(*) - 1)::DOUBLE / count(*) ELSE 0.0 END AS reorder_rate
        FROM stg_transactions GROUP BY user_id""",
    "recon": """SELECT settlement_date, merchant_id, expected_amount,
        coalesce(actual_amount, 0) AS actual_amount, expected_amount - coalesce(actual_amount, 0) AS variance,
        CASE WHEN expected_amount > 0
          THEN (expected_amount - coalesce(actual_amount, 0))::DOUBLE / expected_amount::DOUBLE ELSE 0.0 END AS variance_pct,
        CASE WHEN abs(expected_amount - coalesce(actual_amount, 0)) < 0.01 THEN 'matched'
          WHEN actual_amount IS NULL THEN 'pending' ELSE 'mismatch' END AS status
        FROM (SELECT created_at::DATE AS settlement_date, merchant_id,
                coalesce(sum(amount) FILTER (status = 'approved'), 0) AS expected_amount
              FROM stg_transactions GROUP BY ALL) e
        LEFT JOIN (SELECT paid_at::DATE AS settlement_date, t.merchant_id, sum(r.amount) AS actual_amount
              FROM repayments r LEFT JOIN stg_transactions t USING (transaction_id)
              WHERE r.status = 'paid' AND paid_at IS NOT NULL GROUP BY ALL) a
        USING (settlement_date, merchant_id)""",
    "risk": """SELECT d.*, coalesce(o.overdue_rate, 0.0) AS overdue_rate FROM (
        SELECT created_at::DATE AS date, count(*) FILTER (status = 'approved')::DOUBLE / count(*) AS approval_rate,
          count(*) FILTER (status = 'declined')::DOUBLE / count(*) AS decline_rate,
          avg(decision_latency_ms) AS avg_decision_latency_ms, 0::BIGINT AS fraud_flag_count,
          coalesce(sum(amount) FILTER (status = 'approved'), 0) AS total_exposure
        FROM stg_transactions GROUP BY ALL) d
        LEFT JOIN (SELECT due_date AS date, count(*) FILTER (status = 'overdue')::DOUBLE / count(*) AS overdue_rate
        FROM repayments GROUP BY ALL) o ON d.date = o.date""",
    "features": _FEATURE_SQL.format(hours=4, snaps=_snaps([AS_OF])),
    "feature_history": _FEATURE_SQL.format(hours=HISTORY_HOURS, snaps=f"""(SELECT unnest(generate_series(
        min(created_at)::DATE::TIMESTAMP, max(created_at) + INTERVAL {SNAPSHOT_DAYS} DAY, INTERVAL {SNAPSHOT_DAYS} DAY)) AS s
        FROM stg_transactions)"""),
    "requests": "SELECT transaction_id AS request_id, user_id, "
    "CASE WHEN transaction_id % 50 <> 0 THEN created_at END AS as_of FROM transactions",
}


def with_views(sql: str) -> str:
    """Prefix the SQL with the views it names, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    body = sql.strip()
    if not order:
        return body
    ctes = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    if re.match(r"(?i)with\s+(?!recursive)", body):
        return f"WITH {ctes}, {body[5:].lstrip()}"
    return f"WITH {ctes} {body}"


def numeric(sql_columns: list[str], digits: int = 6) -> str:
    """Select-list items that turn numbers into doubles of fixed digits."""
    return ", ".join(f"round({c}::DOUBLE, {digits}) AS {c}" for c in sql_columns)
