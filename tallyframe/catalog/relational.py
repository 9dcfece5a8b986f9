"""Joins, marts, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.catalog.base import AS_OF, Data, add, query
from tallyframe.checks import expect, generic
from tallyframe.operators import asof, ordered, setops, states, tables
from tallyframe.operators.latest import apply_cdc, deduplicate, latest_by
from tallyframe.operators.quantiles import approx_quantiles, exact_quantiles
from tallyframe.plans import marts, monitoring
from tallyframe.session import shared_path
from tallyframe.sources import domain

D = "::DOUBLE"
T_AS_OF = f"TIMESTAMP '{AS_OF}'"

KPI_SQL = """SELECT merchant_id, merchant_category, date, gmv::DOUBLE AS gmv, transaction_count, approved_count,
  declined_count, round(approval_rate, 6) AS approval_rate, round(avg_basket_size, 6) AS avg_basket_size,
  round(bnpl_penetration, 6) AS bnpl_penetration FROM {src}"""

# -- marts ------------------------------------------------------------------------------------------

add("mart_01_merchant_daily_kpis", lambda d: d.kpis, KPI_SQL.format(src="kpis"))

COHORT_SQL = """SELECT cohort_month, user_id, ltv::DOUBLE AS ltv, total_transactions,
  total_repaid::DOUBLE AS total_repaid, retention_months, round(reorder_rate, 6) AS reorder_rate FROM cohorts"""
add("mart_02_user_cohorts", lambda d: d.cohorts, COHORT_SQL)
add(
    "mart_02_user_cohorts_repaid",
    lambda d: marts.user_cohorts(d.stg_tx, d.repay).select("user_id", "ltv", "total_repaid_actual"),
    """SELECT c.user_id, c.ltv::DOUBLE AS ltv, coalesce(p.paid, 0)::DOUBLE AS total_repaid_actual FROM cohorts c
    LEFT JOIN (SELECT user_id, sum(amount) AS paid FROM repayments WHERE status = 'paid' GROUP BY 1) p
    USING (user_id)""",
)
RECON_SQL = """SELECT settlement_date, merchant_id, expected_amount::DOUBLE AS expected_amount,
  actual_amount::DOUBLE AS actual_amount, variance::DOUBLE AS variance, round(variance_pct, 6) AS variance_pct,
  status FROM recon"""
add("mart_03_settlement_reconciliation", lambda d: d.recon, RECON_SQL)


@query(
    "mart_04_settlement_daily",
    f"""SELECT last_day::DATE + 1 AS settlement_date, merchant_id, expected_amount::DOUBLE AS expected_amount,
      transaction_count, coalesce(actual_amount, 0)::DOUBLE AS actual_amount,
      (expected_amount - coalesce(actual_amount, 0))::DOUBLE AS variance,
      round(abs(expected_amount - coalesce(actual_amount, 0))::DOUBLE / expected_amount::DOUBLE * 100, 6) AS variance_pct,
      CASE WHEN abs(expected_amount - coalesce(actual_amount, 0))::DOUBLE / expected_amount::DOUBLE * 100 <= 0.1
        THEN 'matched' ELSE 'mismatch' END AS status
    FROM (SELECT t.merchant_id, m.last_day, sum(amount) AS expected_amount, count(*) AS transaction_count
          FROM stg_transactions t, (SELECT max(created_at)::DATE AS last_day FROM stg_transactions) m
          WHERE created_at::DATE = m.last_day AND status = 'approved' GROUP BY ALL) e
    LEFT JOIN (SELECT t.merchant_id, sum(r.amount) AS actual_amount FROM repayments r
          JOIN stg_transactions t USING (transaction_id), (SELECT max(created_at)::DATE AS ld FROM stg_transactions)
          WHERE r.status = 'paid' AND r.paid_at::DATE = ld GROUP BY 1) a USING (merchant_id)""",
)
def _settlement_daily(d: Data):
    newest = d.stg_tx.agg(F.max("created_at").alias("m")).scalar()
    run = F.date_add(F.to_date(newest), 1).cast("timestamp_ntz")
    actual = marts.actual_settlements(d.repay, d.stg_tx).where(F.col("settlement_date") == F.to_date(newest))
    return marts.settlement_daily(d.stg_tx, actual, run)


RISK_SQL = """SELECT date, round(approval_rate, 6) AS approval_rate, round(decline_rate, 6) AS decline_rate,
  round(avg_decision_latency_ms, 6) AS avg_decision_latency_ms, fraud_flag_count,
  total_exposure::DOUBLE AS total_exposure, round(overdue_rate, 6) AS overdue_rate FROM risk"""
add("mart_05_risk_dashboard", lambda d: d.risk, RISK_SQL)

# -- joins --------------------------------------------------------------------------------------------

add(
    "join_01_transaction_enriched",
    lambda d: d.enriched,
    """SELECT * REPLACE (amount::DOUBLE AS amount, user_credit_limit::DOUBLE AS user_credit_limit,
      merchant_commission_rate::DOUBLE AS merchant_commission_rate) FROM tx_enriched""",
)
add(
    "join_02_repayment_timeline",
    lambda d: marts.repayment_timeline(d.repay, d.stg_tx, d.now),
    f"""SELECT r.repayment_id, r.transaction_id, r.user_id, r.installment_number, r.amount::DOUBLE AS repayment_amount,
      r.due_date, r.paid_at, r.status AS repayment_status, t.amount::DOUBLE AS transaction_amount,
      t.status AS transaction_status, t.merchant_id,
      date_diff('day', r.due_date, coalesce(r.paid_at::DATE, {T_AS_OF}::DATE)) AS days_from_due
    FROM repayments r LEFT JOIN stg_transactions t USING (transaction_id)""",
)
add(
    "join_03_user_credit_history",
    lambda d: marts.user_credit_history(d.stg_tx, d.silver_repay),
    """SELECT t.user_id, t.transaction_id, t.amount::DOUBLE AS tx_amount, t.status AS tx_status, t.merchant_id,
      t.created_at AS tx_date, r.repayment_id, r.amount::DOUBLE AS repayment_amount, r.status AS repayment_status,
      r.due_date, r.paid_at FROM stg_transactions t LEFT JOIN repayments r USING (transaction_id)""",
)
FEATURE_SELECT = """SELECT user_id, snapshot_ts, valid_from, valid_to, feature_version, tx_velocity_7d, tx_velocity_30d,
  avg_tx_amount_30d::DOUBLE AS avg_tx_amount_30d, round(repayment_rate_90d, 6) AS repayment_rate_90d,
  merchant_diversity_30d, round(declined_rate_7d, 6) AS declined_rate_7d, active_installments,
  days_since_first_tx FROM {src}"""
add(
    "join_04_assemble_features",
    lambda d: d.features.select("user_id", "tx_velocity_30d", "repayment_rate_90d", "active_installments"),
    "SELECT user_id, tx_velocity_30d, round(repayment_rate_90d, 6) AS repayment_rate_90d, active_installments FROM features",
)
add(
    "join_05_composite_key_left",
    lambda d: marts.expected_settlements(d.stg_tx).join(
        marts.actual_settlements(d.repay, d.stg_tx), ["settlement_date", "merchant_id"], "left"
    ).groupBy("merchant_id").agg(
        F.sum("expected_amount").alias("expected"), F.coalesce(F.sum("actual_amount"), F.lit(0)).alias("actual"),
        F.count("actual_amount").alias("days_with_actual"),
    ),
    """SELECT merchant_id, sum(expected_amount)::DOUBLE AS expected, sum(actual_amount)::DOUBLE AS actual,
      count(*) FILTER (actual_amount > 0) AS days_with_actual FROM recon GROUP BY 1""",
)
add(
    "join_06_daily_aggregates_left",
    lambda d: d.risk.select("date", "approval_rate", "overdue_rate"),
    "SELECT date, round(approval_rate, 6) AS approval_rate, round(overdue_rate, 6) AS overdue_rate FROM risk",
)
add(
    "join_07_theta_residual",
    lambda d: d.stg_tx.join(
        d.users.select("user_id", "credit_limit"), "user_id"
    ).where(F.col("amount").cast("double") > F.col("credit_limit").cast("double") * 2.0).select("transaction_id"),
    """SELECT transaction_id FROM stg_transactions t JOIN users u USING (user_id)
      WHERE t.amount::DOUBLE > u.credit_limit::DOUBLE * 2.0""",
)
add(
    "join_08_anti",
    lambda d: generic.relationships_where(d.repay, "transaction_id", d.stg_tx, "transaction_id"),
    """SELECT r.transaction_id AS missing_key, count(*) AS n_records FROM repayments r
      WHERE NOT EXISTS (SELECT 1 FROM stg_transactions t WHERE t.transaction_id = r.transaction_id) GROUP BY 1""",
)
add(
    "join_09_semi",
    lambda d: expect.values_not_in_set(
        d.stg_tx, "merchant_id", d.merchants.where("risk_tier = 'high'").select("merchant_id")
    ).select("transaction_id", "merchant_id"),
    """SELECT transaction_id, merchant_id FROM stg_transactions
      WHERE merchant_id IN (SELECT merchant_id FROM merchants WHERE risk_tier = 'high')""",
)
ASOF_SQL = """SELECT r.request_id, r.user_id, r.as_of, CASE WHEN f.valid_to > r.as_of THEN f.valid_from END AS valid_from,
  CASE WHEN f.valid_to > r.as_of THEN f.valid_to END AS valid_to,
  CASE WHEN f.valid_to > r.as_of THEN f.tx_velocity_30d END AS tx_velocity_30d
  FROM requests r ASOF LEFT JOIN feature_history f ON r.user_id = f.user_id AND r.as_of >= f.valid_from"""
add(
    "join_10_as_of",
    lambda d: asof.asof_join(
        d.requests, d.history, ["user_id"], "as_of", "valid_from", "valid_to", ["tx_velocity_30d"], ["snapshot_ts"]
    ),
    ASOF_SQL,
)
# every fifth user's versions stay open far beyond the next ones, and one in seven versions ends within a day
OPEN_SQL = """(SELECT user_id, snapshot_ts, valid_from, CASE WHEN user_id % 5 = 0 AND month(valid_from) = 2
    THEN valid_from + INTERVAL 400 DAY WHEN (user_id + month(valid_from)) % 7 = 0 THEN valid_from + INTERVAL 1 DAY
    ELSE valid_to END AS valid_to, tx_velocity_30d FROM feature_history)"""


OLDER_SQL = f"""SELECT r.request_id, r.user_id, r.as_of, f.valid_from, f.valid_to, f.tx_velocity_30d FROM requests r
  LEFT JOIN {OPEN_SQL} f ON r.user_id = f.user_id AND f.valid_from <= r.as_of AND f.valid_to > r.as_of
  QUALIFY row_number() OVER (PARTITION BY r.request_id ORDER BY f.valid_from DESC NULLS LAST) = 1"""


def open_history(d: Data):
    month = F.month("valid_from")
    ends = F.when((F.col("user_id") % 5 == 0) & (month == 2), F.col("valid_from") + F.expr("interval 400 days")).when(
        (F.col("user_id") + month) % 7 == 0, F.col("valid_from") + F.expr("interval 1 day")
    )
    return d.history.withColumn("valid_to", F.coalesce(ends, "valid_to"))


add(
    "join_10_as_of_older_open",
    lambda d: asof.asof_join(
        d.requests, open_history(d), ["user_id"], "as_of", "valid_from", "valid_to", ["tx_velocity_30d"], ["snapshot_ts"]
    ),
    OLDER_SQL,
)
add(
    "join_11_as_of_or_latest",
    lambda d: asof.asof_or_latest(
        d.requests, d.history, ["user_id"], "as_of", "valid_from", "valid_to", ["tx_velocity_30d"], ["snapshot_ts"]
    ),
    """WITH hit AS (SELECT r.*, f.valid_from AS vf, f.valid_to AS vt, f.tx_velocity_30d AS v
      FROM requests r ASOF LEFT JOIN feature_history f ON r.user_id = f.user_id AND r.as_of >= f.valid_from),
    newest AS (SELECT * FROM feature_history QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC) = 1)
    SELECT request_id, h.user_id, as_of,
      CASE WHEN vt > as_of THEN vf ELSE n.valid_from END AS valid_from,
      CASE WHEN vt > as_of THEN vt ELSE n.valid_to END AS valid_to,
      CASE WHEN vt > as_of THEN v ELSE n.tx_velocity_30d END AS tx_velocity_30d,
      CASE WHEN vt > as_of THEN 'as_of' WHEN n.user_id IS NOT NULL THEN 'latest' ELSE 'none' END AS match
    FROM hit h LEFT JOIN newest n ON h.user_id = n.user_id""",
)
add(
    "join_10_as_of_overlapping",
    lambda d: asof.asof_range_join(
        d.requests, open_history(d), ["user_id"], ["request_id"], "as_of", "valid_from", "valid_to",
        ["tx_velocity_30d"], ["snapshot_ts"],
    ),
    OLDER_SQL,
)
add(
    "join_12_full_outer_reconciliation",
    lambda d: expect.equal_expression(
        d.stg_tx, F.sum("amount").cast("decimal(25,2)"), d.repay, F.sum("amount").cast("decimal(25,2)"),
        group_by=["user_id"], tolerance=1000.0,
    ).withColumnRenamed("col_1", "user_id"),
    """SELECT coalesce(a.user_id, b.user_id) AS user_id, a.x::DOUBLE AS expression, b.x::DOUBLE AS compare_expression,
      abs(coalesce(a.x, 0) - coalesce(b.x, 0))::DOUBLE AS expression_difference,
      round(abs(coalesce(a.x, 0) - coalesce(b.x, 0))::DOUBLE / nullif(a.x, 0)::DOUBLE, 6) AS expression_difference_percent
      FROM (SELECT user_id, sum(amount) AS x FROM stg_transactions GROUP BY 1) a
      FULL JOIN (SELECT user_id, sum(amount) AS x FROM repayments GROUP BY 1) b ON a.user_id IS NOT DISTINCT FROM b.user_id
      WHERE abs(coalesce(a.x, 0) - coalesce(b.x, 0)) > 1000.0""",
)
add(
    "join_13_scalar_rates",
    lambda d: monitoring.approval_rate_drop(d.stg_tx, F.lit("2001-07-31 12:00:00").cast("timestamp_ntz")),
    """SELECT round(b.r - c.r, 6) AS measure, 'warning' AS severity, coalesce(b.r - c.r > 15, false) AS firing
      FROM (SELECT count(*) FILTER (status = 'approved') * 100.0::DOUBLE / nullif(count(*), 0) AS r FROM stg_transactions
            WHERE created_at >= TIMESTAMP '2001-07-31 12:00:00' - INTERVAL 24 HOUR) b,
           (SELECT count(*) FILTER (status = 'approved') * 100.0::DOUBLE / nullif(count(*), 0) AS r FROM stg_transactions
            WHERE created_at >= TIMESTAMP '2001-07-31 12:00:00' - INTERVAL 1 HOUR) c""",
)


@query(
    "join_14_range",
    """WITH b AS (SELECT date_trunc('month', min(created_at))::DATE AS lo, max(created_at)::DATE AS hi FROM stg_transactions),
    months AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS month_start FROM b)
    SELECT m.month_start, count(*) AS n FROM stg_transactions t JOIN months m
      ON t.created_at::DATE BETWEEN m.month_start AND (m.month_start + INTERVAL 1 MONTH)::DATE - 1 GROUP BY 1""",
)
def _range_join(d: Data):
    """Days meet their month by BETWEEN on a spine of one row per month; facts shrink to days first."""
    bounds = d.stg_tx.agg(
        F.trunc(F.min("created_at"), "month").alias("lo"), F.to_date(F.max("created_at")).alias("hi")
    )
    months = tables.date_spine(bounds, "lo", "hi", "month", inclusive=True, name="month_start")
    daily = d.stg_tx.groupBy(F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.join(
        F.broadcast(months), F.col("day").between(F.col("month_start"), F.last_day("month_start"))
    ).groupBy("month_start").agg(F.sum("n").alias("n"))


@query(
    "join_15_spine_left",
    """WITH b AS (SELECT date_trunc('minute', min(created_at))::TIMESTAMP AS lo, max(created_at) AS hi FROM app_events)
    SELECT s.slot, count(e.event_id) AS n FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS slot FROM b) s
    LEFT JOIN app_events e ON date_trunc('minute', e.created_at) = s.slot GROUP BY 1""",
)
def _spine(d: Data):
    """Events per minute with the empty minutes shown."""
    minute = F.date_trunc("minute", "created_at").cast("timestamp_ntz")
    bounds = d.events.agg(F.min(minute).alias("lo"), F.max("created_at").alias("hi"))
    spine = tables.date_spine(bounds, "lo", "hi", "minute", inclusive=True, name="slot")
    counts = d.events.groupBy(minute.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "slot", "left").select("slot", F.coalesce("n", F.lit(0)).alias("n"))


add(
    "join_16_dedup_by_key",
    lambda d: deduplicate(d.tx, ["user_id"], [F.desc("created_at"), F.desc("transaction_id")]).select(
        "user_id", "transaction_id", "created_at"
    ),
    """SELECT user_id, transaction_id, created_at FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY created_at DESC, transaction_id DESC) AS rn FROM transactions) WHERE rn = 1""",
)
add(
    "join_17_scalar_lookup",
    lambda d: asof.asof_join(
        d.tx.select("transaction_id", "user_id", "created_at"), d.history, ["user_id"], "created_at",
        "valid_from", "valid_to", ["avg_tx_amount_30d"], ["snapshot_ts"],
    ).select("transaction_id", "avg_tx_amount_30d"),
    """SELECT t.transaction_id, CASE WHEN f.valid_to > t.created_at THEN f.avg_tx_amount_30d::DOUBLE END AS avg_tx_amount_30d
      FROM transactions t ASOF LEFT JOIN feature_history f ON t.user_id = f.user_id AND t.created_at >= f.valid_from""",
)

# -- aggregates -------------------------------------------------------------------------------------------

add(
    "agg_01_conditional",
    lambda d: d.stg_tx.groupBy("merchant_id").agg(
        F.count_if(F.col("status") == "approved").alias("approved"),
        F.coalesce(F.sum(F.when(F.col("status") == "approved", F.col("amount"))), F.lit(0)).alias("approved_amount"),
        F.avg(F.when(F.col("status") == "declined", F.col("amount").cast("double"))).alias("avg_declined"),
        F.count_distinct(F.when(F.col("status") == "pending", F.col("user_id"))).alias("pending_users"),
    ),
    """SELECT merchant_id, count(*) FILTER (status = 'approved') AS approved,
      coalesce(sum(amount) FILTER (status = 'approved'), 0)::DOUBLE AS approved_amount,
      round(avg(amount::DOUBLE) FILTER (status = 'declined'), 6) AS avg_declined,
      count(DISTINCT user_id) FILTER (status = 'pending') AS pending_users FROM stg_transactions GROUP BY 1""",
)
add(
    "agg_02_exact_distinct",
    lambda d: d.tx.groupBy("status").agg(F.count_distinct("user_id").alias("users")),
    "SELECT status, count(DISTINCT user_id) AS users FROM transactions GROUP BY 1",
)
add(
    "agg_03_approx_distinct",
    # the estimate beside the exact number: five standard errors at most
    lambda d: d.tx.groupBy("status").agg(
        F.count_distinct("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("_estimate")
    ).select("status", "users", (F.abs(F.col("_estimate") - F.col("users")) <= F.col("users") * 0.1).alias("close")),
    "SELECT status, count(DISTINCT user_id) AS users, true AS close FROM transactions GROUP BY 1",
)
add(
    "agg_04_quantiles_exact",
    lambda d: exact_quantiles(
        d.tx, "decision_latency_ms", {"q25": 0.25, "median": 0.5, "q75": 0.75, "q95": 0.95, "q99": 0.99}, ["status"]
    ),
    """SELECT status, quantile_cont(decision_latency_ms, 0.25)::DOUBLE AS q25, median(decision_latency_ms)::DOUBLE AS median,
      quantile_cont(decision_latency_ms, 0.75)::DOUBLE AS q75, round(quantile_cont(decision_latency_ms, 0.95)::DOUBLE, 6) AS q95,
      round(quantile_cont(decision_latency_ms, 0.99)::DOUBLE, 6) AS q99 FROM transactions GROUP BY 1""",
)
add(
    "agg_04_quantiles_approx",
    # the estimates lie between exact quantiles half a percent below and above
    lambda d: exact_quantiles(
        d.tx, "decision_latency_ms", {"lo": 0.495, "hi": 0.505, "lo95": 0.945, "hi95": 0.955}, ["status"]
    ).join(approx_quantiles(d.tx, "decision_latency_ms", {"median": 0.5, "q95": 0.95}, ["status"]), "status").select(
        "status", F.col("median").between(F.floor("lo"), F.ceil("hi")).alias("median_close"),
        F.col("q95").between(F.floor("lo95"), F.ceil("hi95")).alias("q95_close"),
    ),
    "SELECT status, true AS median_close, true AS q95_close FROM transactions GROUP BY 1",
)
EXPOSURE_SQL = "SELECT user_id, sum(amount)::DOUBLE AS active_exposure FROM transactions WHERE status = 'approved' GROUP BY 1"
add(
    "agg_05_partial_state_merge",
    lambda d: marts.merge_exposure(marts.exposure_partials(d.tx, F.date_format("created_at", "yyyyMM"))),
    EXPOSURE_SQL,
)


# money, users and latency per month and status, as states
MONTHLY = states.StateSpec(
    ["status"], sums={"amount": "amount"}, distinct={"users": "user_id"}, members={"buyers": "user_id"},
    quantiles={"latency": "decision_latency_ms"},
)


def _monthly(d: Data):
    """The stored states: a first load with one month half missing, then that month replaced."""

    def build():
        path = shared_path(d.spark, "monthly-states")
        month = F.date_format("created_at", "yyyyMM")
        faulty = d.tx.where((month != "199806") | (F.col("transaction_id") % 2 == 0))
        states.replace_periods(states.build_states(faulty, month, MONTHLY), path)
        states.replace_periods(states.build_states(d.tx.where(month == "199806"), month, MONTHLY), path)
        return states.read_states(d.spark, path)

    return d.stored("monthly-states", build)


@query("agg_03_stored_distinct", "SELECT status, count(DISTINCT user_id) AS users, true AS close FROM transactions GROUP BY 1")
def _stored_distinct(d: Data):
    """Users per status from the stored months, beside the exact number."""
    near = states.answers(states.merge_states(_monthly(d), MONTHLY), MONTHLY).select("status", F.col("users").alias("_near"))
    exact = d.tx.groupBy("status").agg(F.count_distinct("user_id").alias("users"))
    return exact.join(near, "status").select(
        "status", "users", (F.abs(F.col("_near") - F.col("users")) <= F.col("users") * states.hll_bound()).alias("close")
    )


@query(
    "agg_03_stored_retention",
    """SELECT b.status, b.n AS members_before, true AS before_close, true AS both_close FROM
      (SELECT status, count(DISTINCT user_id) AS n FROM transactions WHERE year(created_at) = 1996 GROUP BY 1) b""",
)
def _stored_retention(d: Data):
    """Users of 1996 who came back in 1998, from Theta states; both numbers beside the exact ones."""
    year = F.substring("period", 1, 4)
    near = states.retained(_monthly(d), MONTHLY, "buyers", year == "1996", year == "1998")
    by_user = d.tx.groupBy("status", "user_id").agg(
        F.bool_or(F.year("created_at") == 1996).alias("_b"), F.bool_or(F.year("created_at") == 1998).alias("_a")
    )
    exact = by_user.groupBy("status").agg(F.count_if("_b").alias("_before"), F.count_if(F.col("_b") & F.col("_a")).alias("_both"))
    # an intersection errs by the size of the union
    close = lambda a, b, size: F.abs(F.col(a) - F.col(b)) <= F.col(size) * 0.08
    return exact.where("_before > 0").join(near, "status").select(
        "status", F.col("_before").alias("members_before"), close("members_before", "_before", "_before").alias("before_close"),
        close("members_both", "_both", "_before").alias("both_close"),
    )


@query(
    "agg_05_stored_state_merge",
    """SELECT substr(m, 1, 4) AS year, status, count(*) AS rows, sum(amount)::DOUBLE AS sum_amount, true AS median_close
      FROM (SELECT *, strftime(created_at, '%Y%m') AS m FROM transactions) GROUP BY 1, 2""",
)
def _stored_merge(d: Data):
    """Monthly states merged to years: counts and sums exact, the median between exact quantiles a rank error around it."""
    by = ["year", "status"]
    yearly = states.merge_states(_monthly(d).withColumn("year", F.substring("period", 1, 4)), MONTHLY, by)
    near = states.answers(yearly, MONTHLY, {"median": 0.5})
    bound = states.kll_bound() + 0.001
    exact = exact_quantiles(
        d.tx.withColumn("year", F.date_format("created_at", "yyyy")), "decision_latency_ms", {"_lo": 0.5 - bound, "_hi": 0.5 + bound}, by
    )
    return near.join(exact, by).select(
        *by, "rows", "sum_amount", F.col("latency_median").between(F.floor("_lo"), F.ceil("_hi")).alias("median_close")
    )


@query("agg_05_exposure_latest", """WITH ev AS (SELECT transaction_id, user_id, amount, status, op, row_number() OVER
      (PARTITION BY transaction_id, installment_number ORDER BY updated_at DESC, tie_part DESC, tie_supp DESC,
       amount DESC, tie_qty DESC) AS rn FROM repayment_versions)
    SELECT user_id, sum(amount)::DOUBLE AS active_exposure FROM ev WHERE rn = 1 AND op <> 'd' GROUP BY 1""")
def _exposure_latest(d: Data):
    """The mode that counts each record once: newest version first, then the sum."""
    now = apply_cdc(d.versions, domain.REPAYMENT_KEYS, domain.REPAYMENT_VERSION_ORDER)
    return now.groupBy("user_id").agg(F.sum("amount").cast("decimal(38,2)").alias("active_exposure"))


@query("agg_06_key_summing", KPI_SQL.format(src="kpis"))
def _key_summing(d: Data):
    """KPI parts of two loads, merged by key; equals the mart built at once."""
    parts = d.stg_tx.groupBy("merchant_id", F.to_date("created_at").alias("date"), (F.col("transaction_id") % 2).alias("_load")).agg(
        F.sum("amount").alias("gmv"), F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("status") == "approved").alias("approved_count"),
        F.count_if(F.col("status") == "declined").alias("declined_count"),
        F.count_if(F.col("installment_count") > 1).alias("instalment_count"),
    )
    named = parts.join(d.merchants.select("merchant_id", "merchant_category"), "merchant_id", "left")
    return marts.merge_kpi_parts(named)


add(
    "agg_07_category_month_rollup",
    lambda d: marts.category_month_rollup(d.kpis),
    """SELECT merchant_category, month(date)::INT AS month, sum(gmv)::DOUBLE AS gmv,
      sum(transaction_count)::BIGINT AS transaction_count FROM kpis GROUP BY ALL""",
)
add(
    "agg_07_category_year_month_rollup",
    lambda d: marts.category_month_rollup(d.kpis, by_year=True),
    """SELECT merchant_category, date_trunc('month', date)::DATE AS month, sum(gmv)::DOUBLE AS gmv,
      sum(transaction_count)::BIGINT AS transaction_count FROM kpis GROUP BY ALL""",
)
add(
    "agg_08_cohort_summary",
    lambda d: marts.cohort_summary(d.cohorts),
    """SELECT cohort_month, count(*) AS users, round(avg(ltv::DOUBLE), 6) AS avg_ltv,
      round(avg(retention_months), 6) AS avg_retention FROM cohorts GROUP BY 1""",
)
add(
    "agg_09_counts_per_group",
    lambda d: d.tx.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("amount").cast("double")).alias("avg_amount")),
    "SELECT merchant_id, count(*) AS n, round(avg(amount::DOUBLE), 6) AS avg_amount FROM transactions GROUP BY 1",
)
add(
    "agg_10_settlement_summary",
    lambda d: marts.settlement_summary(d.recon),
    """SELECT settlement_date, count(DISTINCT merchant_id) AS merchants, count(*) FILTER (status = 'matched') AS matched,
      count(*) FILTER (status = 'mismatch') AS mismatches, round(avg(variance_pct), 6) AS avg_variance_pct
      FROM recon GROUP BY 1""",
)
add(
    "agg_11_having",
    lambda d: generic.unique_combination_of_columns(d.versions, ["transaction_id", "installment_number"]),
    """SELECT transaction_id, installment_number, count(*) AS n_records FROM repayment_versions
      GROUP BY 1, 2 HAVING count(*) > 1""",
)
add(
    "agg_12_category_risk",
    lambda d: marts.category_risk(d.stg_tx, d.merchants, d.seed),
    """SELECT merchant_category, display_name, sum(amount)::DOUBLE AS gmv, count(*) AS transaction_count,
      round(sum(amount)::DOUBLE * any_value(risk_weight), 6) AS risk_weighted_gmv
      FROM stg_transactions JOIN merchants USING (merchant_id) JOIN category_seed USING (merchant_category)
      GROUP BY 1, 2""",
)

# -- windows --------------------------------------------------------------------------------------------------

add(
    "win_01_row_number",
    lambda d: latest_by(d.tx, ["user_id"], ["created_at", "transaction_id"]).select("user_id", "transaction_id"),
    """SELECT user_id, transaction_id FROM transactions
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, transaction_id DESC) = 1""",
)


@query(
    "win_02_lead_and_last_flag",
    """SELECT transaction_id, lead(created_at) OVER w AS next_created_at, lead(transaction_id) OVER w IS NULL AS is_last
      FROM transactions WINDOW w AS (PARTITION BY user_id ORDER BY created_at, transaction_id)""",
)
def _lead(d: Data):
    nxt = ordered.with_next(
        d.tx.select("user_id", "created_at", "transaction_id"), ["user_id"], ["created_at", "transaction_id"],
        ["created_at"], "_next",
    )
    return nxt.select(
        "transaction_id", F.col("_next.created_at").alias("next_created_at"), F.col("_next").isNull().alias("is_last")
    )


@query(
    "win_03_lag_ordered_check",
    """SELECT transaction_id FROM (SELECT transaction_id, amount, lag(amount) OVER (PARTITION BY user_id
      ORDER BY created_at, transaction_id) AS p FROM transactions) WHERE NOT (amount > p)""",
)
def _lag(d: Data):
    src = d.tx.select("user_id", "created_at", "transaction_id", "amount")
    return expect.values_increasing(
        src, "amount", ["created_at", "transaction_id"], group_by=["user_id"]
    ).select("transaction_id")


DAILY = "SELECT created_at::DATE AS day, status, sum(amount)::DOUBLE AS v FROM transactions GROUP BY 1, 2"


def _daily(d: Data):
    return d.tx.groupBy(F.to_date("created_at").alias("day"), "status").agg(F.sum("amount").cast("double").alias("v"))


add(
    "win_04_period_difference",
    lambda d: _daily(d).withColumn(
        "diff", F.col("v") - F.lag("v", 7).over(Window.partitionBy("status").orderBy("day"))
    ),
    f"SELECT day, status, round(v, 6) AS v, round(v - lag(v, 7) OVER (PARTITION BY status ORDER BY day), 6) AS diff FROM ({DAILY})",
)


add(
    "win_07_day_after_previous",
    lambda d: d.tx.select("user_id", F.to_date("created_at").alias("day")).distinct().withColumn(
        "not_before", F.date_add(F.lag("day").over(Window.partitionBy("user_id").orderBy("day")), 1)
    ),
    """SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) + 1 AS not_before
      FROM (SELECT DISTINCT user_id, created_at::DATE AS day FROM transactions)""",
)


@query(
    "win_05_trailing_band",
    f"""SELECT day, status, round(avg(v) OVER w, 4) AS avg_7, round(stddev_samp(v) OVER w, 4) AS sd_7 FROM ({DAILY})
      WINDOW w AS (PARTITION BY status ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
)
def _band(d: Data):
    """The frame of seven days before a day, whole across segments."""

    def band(rows, w):
        week = w.rowsBetween(-7, -1)
        return rows.withColumns({"avg_7": F.round(F.avg("v").over(week), 4), "sd_7": F.round(F.stddev_samp("v").over(week), 4)})

    return ordered.with_trailing(_daily(d), ["status"], ["day"], 7, band).select("day", "status", "avg_7", "sd_7")


@query(
    "win_06_whole_frame_stats",
    f"""SELECT day, status, round((v - avg(v) OVER ()) / stddev_samp(v) OVER (), 6) AS z FROM ({DAILY})""",
)
def _whole(d: Data):
    daily = _daily(d)
    s = daily.agg(F.struct(F.avg("v").alias("a"), F.stddev_samp("v").alias("s")).alias("x")).scalar()
    return daily.select("day", "status", ((F.col("v") - s["a"]) / s["s"]).alias("z"))


add(
    "win_07_rank_lag",
    lambda d: d.kpis.groupBy("merchant_id").agg(F.sum("gmv").cast("decimal(25,2)").alias("gmv")).withColumn(
        "merchant_rank", F.rank().over(Window.orderBy(F.desc("gmv"), "merchant_id"))
    ).where("merchant_rank <= 25"),
    """SELECT merchant_id, gmv::DOUBLE AS gmv, merchant_rank FROM (SELECT merchant_id, sum(gmv) AS gmv,
      rank() OVER (ORDER BY sum(gmv) DESC, merchant_id) AS merchant_rank FROM kpis GROUP BY 1) WHERE merchant_rank <= 25""",
)
add(
    "win_08_dense_rank_week",
    lambda d: d.tx.groupBy(
        F.year("created_at").alias("y"), F.to_date(F.date_trunc("week", "created_at")).alias("week_start")
    ).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "week_of_year", F.dense_rank().over(Window.partitionBy("y").orderBy("week_start"))
    ),
    """SELECT y, week_start, n, dense_rank() OVER (PARTITION BY y ORDER BY week_start) AS week_of_year FROM (
      SELECT year(created_at)::INT AS y, date_trunc('week', created_at)::DATE AS week_start, count(*) AS n
      FROM transactions GROUP BY 1, 2)""",
)
add(
    "win_09_top_value",
    lambda d: tables.column_values(d.stg_tx, "merchant_id", max_records=5),
    "SELECT merchant_id, count(*) AS n FROM stg_transactions GROUP BY 1 ORDER BY n DESC, merchant_id LIMIT 5",
)


@query(
    "win_10_running_sum",
    """SELECT transaction_id, sum(amount) OVER (PARTITION BY user_id ORDER BY created_at, transaction_id
        ROWS UNBOUNDED PRECEDING)::DOUBLE AS running_asc,
      sum(amount) OVER (PARTITION BY user_id ORDER BY created_at DESC, transaction_id DESC
        ROWS UNBOUNDED PRECEDING)::DOUBLE AS running_desc FROM transactions""",
)
def _running(d: Data):
    src = d.tx.select("user_id", "created_at", "transaction_id", "amount")
    order = ["created_at", "transaction_id"]
    placed = ordered.place(src, ["user_id"], order)
    up = ordered.with_running_sum(placed, ["user_id"], order, "amount", "running_asc")
    both = ordered.with_running_sum(up, ["user_id"], order, "amount", "running_desc", descending=True)
    return both.select("transaction_id", "running_asc", "running_desc")


# -- sorts and limits -----------------------------------------------------------------------------------------------

TOP_GMV = "SELECT merchant_id, sum(gmv)::DOUBLE AS total_gmv FROM kpis GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
add("top_01_merchants_by_gmv", lambda d: monitoring.top_merchants(d.kpis), TOP_GMV)
add(
    "top_02_kpi_rows_by_gmv",
    lambda d: monitoring.kpi_table(d.kpis, 10).select("merchant_id", "date", "gmv"),
    "SELECT merchant_id, date, gmv::DOUBLE AS gmv FROM kpis ORDER BY kpis.gmv DESC, merchant_id, date LIMIT 10",
)
add(
    "top_03_users_by_exposure",
    lambda d: marts.merge_exposure(marts.exposure_partials(d.tx, F.lit(0))).orderBy(
        F.desc("active_exposure"), "user_id"
    ).limit(10),
    EXPOSURE_SQL + " ORDER BY 2 DESC, 1 LIMIT 10",
)
add(
    "top_04_newest_rows",
    lambda d: monitoring.newest(d.tx, "created_at", 10, "transaction_id").select("transaction_id", "created_at"),
    "SELECT transaction_id, created_at FROM transactions ORDER BY created_at DESC, transaction_id LIMIT 10",
)
add(
    "top_05_newest_settlement_days",
    lambda d: monitoring.newest(marts.settlement_summary(d.recon), "settlement_date", 5).select(
        "settlement_date", "merchants", "matched", "mismatches"
    ),
    """SELECT settlement_date, count(DISTINCT merchant_id) AS merchants, count(*) FILTER (status = 'matched') AS matched,
      count(*) FILTER (status = 'mismatch') AS mismatches FROM recon GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
)
add(
    "top_06_newest_per_key",
    lambda d: asof.latest_per_key(d.history, ["user_id"], "valid_from", ["snapshot_ts"]).select(
        "user_id", "valid_from", "tx_velocity_30d"
    ),
    """SELECT user_id, valid_from, tx_velocity_30d FROM feature_history
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC, snapshot_ts DESC) = 1""",
)
add(
    "top_07_most_frequent_values",
    lambda d: tables.column_values(d.raw("events"), "event_type"),
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
)


@query(
    "top_08_latest_set",
    """SELECT merchant_id, date, round(approval_rate, 6) AS approval_rate FROM kpis
      WHERE date = (SELECT max(date) FROM kpis)""",
)
def _latest_set(d: Data):
    newest = d.stg_tx.agg(F.to_date(F.max("created_at")).alias("m")).scalar()
    return d.kpis.where(F.col("date") == newest).select("merchant_id", "date", "approval_rate").orderBy(
        F.desc("approval_rate"), "merchant_id"
    )


add(
    "top_09_ordered_series",
    lambda d: monitoring.approval_series(d.kpis),
    "SELECT date, merchant_id, round(approval_rate, 6) AS approval_rate FROM kpis",
)

# -- set operations ------------------------------------------------------------------------------------------------------

add(
    "set_01_layer_counts",
    lambda d: setops.labelled_counts({
        "bronze.transactions": d.tx, "silver.transactions": d.stg_tx, "silver.repayments": d.repay,
        "gold.merchant_daily_kpis": d.kpis, "feature_store.user_credit_features": d.features,
    }),
    """SELECT 'bronze.transactions' AS layer, count(*) AS row_count FROM transactions
      UNION ALL SELECT 'silver.transactions', count(*) FROM stg_transactions
      UNION ALL SELECT 'silver.repayments', count(*) FROM repayments
      UNION ALL SELECT 'gold.merchant_daily_kpis', count(*) FROM kpis
      UNION ALL SELECT 'feature_store.user_credit_features', count(*) FROM features""",
)
add(
    "set_02_union_superset",
    lambda d: tables.union_relations({
        "transactions": d.tx.select("transaction_id", "user_id", "currency"),
        "repayments": d.repay.select("repayment_id", "transaction_id", "user_id"),
    }),
    """SELECT 'transactions' AS source_name, transaction_id, user_id, currency, NULL::BIGINT AS repayment_id FROM transactions
      UNION ALL SELECT 'repayments', transaction_id, user_id, NULL, repayment_id FROM repayments""",
)
SYM_DIFF = """SELECT 'a_minus_b' AS which_diff, {c} FROM ({a} EXCEPT {b}) UNION ALL
  SELECT 'b_minus_a', {c} FROM ({b} EXCEPT {a})"""
add(
    "set_03_except_both_ways",
    lambda d: setops.except_both_ways(d.stg_tx.select("transaction_id"), d.repay.select("transaction_id")),
    SYM_DIFF.format(
        c="transaction_id", a="SELECT transaction_id FROM stg_transactions", b="SELECT transaction_id FROM repayments"
    ),
)
add(
    "set_04_except_value_counts",
    lambda d: generic.cardinality_equality(d.stg_tx, "transaction_id", d.repay, "transaction_id"),
    """SELECT coalesce(a.k, b.k) AS value_field, coalesce(a.n, 0) AS count_a, coalesce(b.n, 0) AS count_b
      FROM (SELECT transaction_id AS k, count(*) AS n FROM stg_transactions GROUP BY 1) a
      FULL JOIN (SELECT transaction_id AS k, count(*) AS n FROM repayments GROUP BY 1) b ON a.k = b.k
      WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
)


@query(
    "set_05_shared_columns",
    "SELECT user_id, transaction_id FROM transactions INTERSECT SELECT user_id, transaction_id FROM repayments",
)
def _shared(d: Data):
    """Rows equal on the columns two tables share."""
    names = setops.intersect_names(["user_id", "transaction_id", "currency"], d.repay.columns)
    return d.tx.select(*names).intersect(d.repay.select(*names))


add(
    "set_06_distinct",
    lambda d: d.tx.select("merchant_id", "status").distinct(),
    "SELECT DISTINCT merchant_id, status FROM transactions",
)
