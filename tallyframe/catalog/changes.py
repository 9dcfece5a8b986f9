"""Change-data normalisation, staging, predicates, history and incremental queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe.catalog.base import AS_OF, Data, add, query
from tallyframe.checks import stored
from tallyframe.functions import scalars as S
from tallyframe.operators import cdc, incremental, scd2, states
from tallyframe.operators.latest import apply_cdc, latest_by
from tallyframe.plans import marts, staging
from tallyframe.session import shared_path
from tallyframe.sources import changes, domain

T_AS_OF = f"TIMESTAMP '{AS_OF}'"

# raw events and the plain columns they must come back to
TX_COLS = "transaction_id, user_id, merchant_id, amount::DOUBLE AS amount, currency, status, decision_latency_ms, installment_count, created_at"
OP = "CASE WHEN {k} % 10 = 0 THEN 'd' WHEN {k} % 10 <= 2 THEN 'u' ELSE 'c' END"
MS = "epoch_ms({c})"


def tx_raw(d: Data):
    return changes.transaction_events(d.tx)


def repay_raw(d: Data):
    return changes.repayment_events(d.versions)


def users_raw(d: Data):
    return changes.user_events(d.users)


def merchants_raw(d: Data):
    return changes.merchant_events(d.merchants)


def schedules_raw(d: Data):
    return changes.installment_events(d.schedules)


def event_raw(d: Data):
    return changes.app_event_records(d.events)


def session_raw(d: Data):
    return changes.merchant_session_records(d.events)


META = ["__op", "__source_ts_ms"]


def _renamed(df):
    return df.withColumnsRenamed({"__op": "op", "__source_ts_ms": "source_ts_ms"})


# -- envelopes and masks ------------------------------------------------------------------------------

@query(
    "cdc_01_flatten_envelope",
    f"""SELECT transaction_id, user_id, amount::DOUBLE AS amount, {OP.format(k='transaction_id')} AS op,
      {MS.format(c='created_at')} AS source_ts_ms, CASE WHEN transaction_id % 10 = 0 THEN 'true' ELSE 'false' END AS deleted
      FROM transactions WHERE transaction_id % 17 <> 0""",
)
def _envelope(d: Data):
    """Rows wrapped as before/after/op/source, one in seventeen a tombstone, and flattened again."""
    row = F.struct("transaction_id", "user_id", "amount")
    gone = F.col("__op") == "d"
    wrapped = tx_raw(d).select(
        F.when(
            F.col("transaction_id") % 17 != 0,
            F.struct(
                F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), F.col("__op").alias("op"),
                F.struct(F.col("__source_ts_ms").alias("ts_ms")).alias("source"),
            ),
        ).alias("value")
    )
    flat = cdc.flatten_envelope(wrapped).withColumn("amount", S.decimal_of(F.col("amount"), 2))
    return _renamed(flat).withColumnRenamed("__deleted", "deleted")


add(
    "cdc_02_mask_field", lambda d: cdc.mask(users_raw(d).select("user_id", "national_id"), "national_id"),
    "SELECT user_id, '********' AS national_id FROM users",
)
add(
    "cdc_03_mask_pii", lambda d: d.users.select("user_id", S.mask_pii(F.col("email")).alias("email_hash")),
    "SELECT user_id, upper(sha256(email)) AS email_hash FROM users",
)

# -- typed raw rows --------------------------------------------------------------------------------------

add("cdc_04_type_transactions", lambda d: cdc.type_transactions(tx_raw(d)).drop(*META), f"SELECT {TX_COLS} FROM transactions")
REPAY_COLS = """repayment_id, transaction_id, user_id, installment_number, amount::DOUBLE AS amount, due_date, paid_at,
  lower(status) AS status, updated_at AS created_at, updated_at"""
add("cdc_05_type_repayments", lambda d: cdc.type_repayments(repay_raw(d)).drop(*META), f"SELECT {REPAY_COLS} FROM repayment_versions")
LOAD = "TIMESTAMP '1995-01-01 00:00:00'"
USER_COLS = f"""user_id, full_name, email, NULL::VARCHAR AS phone, sha256(user_id::VARCHAR) AS {{nid}},
  credit_limit::DOUBLE AS credit_limit, credit_tier, kyc_status, {LOAD} AS created_at, {LOAD} AS updated_at"""
add("cdc_06_type_users", lambda d: cdc.type_users(users_raw(d)).drop(*META), f"SELECT {USER_COLS.format(nid='national_id')} FROM users")
MERCHANT_COLS = f"""merchant_id, merchant_name, merchant_category, risk_tier, commission_rate::DOUBLE AS commission_rate,
  credit_limit::DOUBLE AS credit_limit, country, {LOAD} AS created_at, {LOAD} AS updated_at"""
add("cdc_07_type_merchants", lambda d: cdc.type_merchants(merchants_raw(d)).drop(*META), f"SELECT {MERCHANT_COLS} FROM merchants")
SCHEDULE_COLS = """schedule_id, transaction_id, user_id, total_amount::DOUBLE AS total_amount, installment_count,
  ((total_amount * 100)::BIGINT // installment_count)::DOUBLE / 100 AS installment_amount, start_date,
  (start_date + to_months(installment_count::INT))::DATE AS end_date, status, created_at"""
add("cdc_08_type_installments", lambda d: cdc.type_installments(schedules_raw(d)).drop(*META), f"SELECT {SCHEDULE_COLS} FROM installments")
EVENT_TIME = "CASE WHEN event_id % 13 = 0 THEN TIMESTAMP '1970-01-01' ELSE date_trunc('millisecond', created_at) END"
EVENT_USER = "CASE WHEN event_id % 11 = 0 THEN 'u' || user_id ELSE user_id::VARCHAR END"
EVENT_MERCHANT = "CASE WHEN event_id % 3 = 0 THEN '' ELSE (user_id % 100)::VARCHAR END"
EVENT_REST = "event_id::VARCHAR AS event_id, event_type, user_id || '-' || strftime(created_at, '%Y%m%d') AS session_id, 'web' AS device_type, event_data"
add(
    "cdc_09_type_app_events", lambda d: cdc.type_app_events(event_raw(d)),
    f"SELECT {EVENT_REST}, {EVENT_USER} AS user_id, {EVENT_MERCHANT} AS merchant_id, {EVENT_TIME} AS created_at FROM app_events",
)
SESSION_COLS = """'s' || event_id AS session_id, event_type AS action, 'dashboard' AS page, trunc(value)::INT AS duration_seconds,
  date_trunc('millisecond', created_at) AS created_at"""
add(
    "cdc_10_type_merchant_sessions", lambda d: cdc.type_merchant_sessions(session_raw(d)),
    f"SELECT {SESSION_COLS}, CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE (user_id % 100)::VARCHAR END AS merchant_id FROM app_events",
)

# -- silver -----------------------------------------------------------------------------------------------

add(
    "cdc_11_silver_transactions", lambda d: cdc.silver_transactions(cdc.type_transactions(tx_raw(d))),
    f"SELECT {TX_COLS} FROM transactions WHERE transaction_id % 10 <> 0",
)
add(
    "cdc_12_silver_repayments", lambda d: cdc.silver_repayments(cdc.type_repayments(repay_raw(d))),
    f"SELECT {REPAY_COLS} FROM repayment_versions WHERE op <> 'd'",
)
LOAD_MS = "788918400000"
add(
    "cdc_13_silver_users",
    lambda d: cdc.silver_users(cdc.type_users(users_raw(d))).withColumnRenamed("_version", "row_version"),
    f"SELECT {USER_COLS.format(nid='national_id_hash')}, {LOAD_MS} + user_id AS row_version FROM users WHERE user_id % 10 <> 0",
)
add(
    "cdc_14_silver_merchants",
    lambda d: cdc.silver_merchants(cdc.type_merchants(merchants_raw(d))).withColumnRenamed("_version", "row_version"),
    f"SELECT {MERCHANT_COLS}, {LOAD_MS} + merchant_id AS row_version FROM merchants WHERE merchant_id % 10 <> 0",
)
add(
    "cdc_15_silver_installments", lambda d: cdc.silver_installments(cdc.type_installments(schedules_raw(d))),
    f"SELECT {SCHEDULE_COLS} FROM installments WHERE schedule_id % 10 <> 0",
)
add(
    "cdc_16_silver_app_events", lambda d: cdc.silver_app_events(cdc.type_app_events(event_raw(d))),
    f"""SELECT {EVENT_REST}, CASE WHEN event_id % 11 = 0 THEN 0 ELSE user_id END AS user_id,
      CASE WHEN event_id % 3 <> 0 THEN (user_id % 100)::INT END AS merchant_id, {EVENT_TIME} AS created_at
      FROM app_events WHERE event_id % 13 <> 0""",
)
add(
    "cdc_17_silver_merchant_sessions", lambda d: cdc.silver_merchant_sessions(cdc.type_merchant_sessions(session_raw(d))),
    f"SELECT {SESSION_COLS}, CASE WHEN event_id % 7 = 0 THEN 0 ELSE (user_id % 100)::INT END AS merchant_id FROM app_events",
)


def _five(d: Data) -> dict:
    return {
        "transactions": (tx_raw(d), "transaction_id"), "repayments": (repay_raw(d), "repayment_id"),
        "users": (users_raw(d), "user_id"), "merchants": (merchants_raw(d), "merchant_id"),
        "installments": (schedules_raw(d), "schedule_id"),
    }


def _audit_sql(op: str, col: str) -> str:
    keyed = "{k} % 10 = 0" if op == "d" else "{k} % 10 BETWEEN 1 AND 2"
    cond = keyed.format
    load = f"make_timestamp(({LOAD_MS} + {{k}}) * 1000)"
    rows = [
        ("transactions", "transaction_id", "date_trunc('millisecond', created_at)", "transactions", cond(k="transaction_id")),
        ("repayments", "repayment_id", "date_trunc('millisecond', updated_at)", "repayment_versions", f"op = '{op}'"),
        ("users", "user_id", load.format(k="user_id"), "users", cond(k="user_id")),
        ("merchants", "merchant_id", load.format(k="merchant_id"), "merchants", cond(k="merchant_id")),
        ("installments", "schedule_id", "date_trunc('millisecond', created_at)", "installments", cond(k="schedule_id")),
    ]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, {k}::VARCHAR AS record_id, {c} AS {col}, {c} AS source_ts FROM {src} WHERE {w}"
        for t, k, c, src, w in rows
    )


add("cdc_18_delete_audit", lambda d: cdc.delete_audit(_five(d)).drop("raw_payload"), _audit_sql("d", "deleted_at"))
add("cdc_19_update_audit", lambda d: cdc.update_audit(_five(d)).drop("raw_payload"), _audit_sql("u", "updated_at"))
LATEST_SQL = "SELECT transaction_id, installment_number, amount::DOUBLE AS amount, updated_at, op FROM repayments"
add(
    "cdc_20_latest_by",
    lambda d: latest_by(d.versions, domain.REPAYMENT_KEYS, domain.REPAYMENT_VERSION_ORDER).select(
        "transaction_id", "installment_number", "amount", "updated_at", "op"
    ),
    LATEST_SQL,
)
add(
    "cdc_21_apply_cdc",
    lambda d: apply_cdc(d.versions, domain.REPAYMENT_KEYS, domain.REPAYMENT_VERSION_ORDER).select(
        "transaction_id", "installment_number", "amount", "updated_at", "op"
    ),
    LATEST_SQL + " WHERE op <> 'd'",
)
add(
    "cdc_22_parse_event_data",
    lambda d: cdc.parse_event_data(d.events).select("event_id", "payload_k", "page", "geo_lat"),
    """SELECT event_id, (event_data->>'k')::BIGINT AS payload_k, event_data->>'page' AS page,
      (event_data->>'$.geo.lat')::DOUBLE AS geo_lat FROM app_events""",
)
add(
    "cdc_23_stamp_ingest",
    lambda d: cdc.stamp_ingest(d.tx.select("transaction_id"), d.now).withColumnRenamed("_ingested_at", "ingested_at"),
    f"SELECT transaction_id, {T_AS_OF} AS ingested_at FROM transactions",
)

# -- staging ------------------------------------------------------------------------------------------------------

add("stg_01_transactions", lambda d: d.stg_tx, f"SELECT {TX_COLS} FROM stg_transactions")
add(
    "stg_02_repayments", lambda d: d.repay.select("repayment_id", "transaction_id", "user_id", "amount", "due_date", "paid_at", "status"),
    "SELECT repayment_id, transaction_id, user_id, amount::DOUBLE AS amount, due_date, paid_at, status FROM repayments",
)
add(
    "stg_03_users",
    lambda d: staging.stg_users(cdc.silver_users(cdc.type_users(users_raw(d)))).select("user_id", "credit_tier", "credit_limit"),
    "SELECT user_id, credit_tier, credit_limit::DOUBLE AS credit_limit FROM users WHERE user_id % 10 <> 0",
)
add(
    "stg_04_merchants",
    lambda d: staging.stg_merchants(cdc.silver_merchants(cdc.type_merchants(merchants_raw(d)))).select("merchant_id", "risk_tier"),
    "SELECT merchant_id, risk_tier FROM merchants WHERE merchant_id % 10 <> 0",
)
add(
    "stg_05_app_events",
    lambda d: staging.stg_app_events(d.events, ["event_id", "user_id", "event_type", "created_at"]),
    "SELECT event_id, user_id, event_type, created_at FROM app_events",
)
add(
    "pred_01_predicates",
    lambda d: d.tx.where(
        "status not in ('cancelled', 'declined') and amount between 1000 and 200000 and decision_latency_ms is not null "
        "and (currency like 'S%' or installment_count <> 4)"
    ).select("transaction_id"),
    """SELECT transaction_id FROM transactions WHERE status NOT IN ('cancelled', 'declined') AND amount BETWEEN 1000 AND 200000
      AND decision_latency_ms IS NOT NULL AND (currency LIKE 'S%' OR installment_count <> 4)""",
)
add(
    "pred_02_recent", lambda d: staging.recent(d.tx, "created_at", "90 days", d.now).select("transaction_id", "created_at"),
    f"SELECT transaction_id, created_at FROM transactions WHERE created_at >= {T_AS_OF} - INTERVAL 90 DAY",
)


@query(
    "pred_03_scalar_subquery",
    """SELECT transaction_id, created_at FROM transactions
      WHERE created_at::DATE >= (SELECT max(created_at)::DATE FROM transactions) - 3""",
)
def _subquery(d: Data):
    newest = d.tx.agg(F.to_date(F.max("created_at")).alias("m")).scalar()
    return d.tx.where(F.col("created_at") >= F.date_sub(newest, 3)).select("transaction_id", "created_at")


# -- slowly changing dimensions -----------------------------------------------------------------------------------

CHECKED = ["credit_tier", "credit_limit", "kyc_status"]


def _dim_then(d: Data):
    """The user dimension before the change: every 20th user missing, some limits and tiers different."""
    return d.users.where("user_id % 20 <> 7").select(
        "user_id",
        F.expr("case when user_id % 9 = 0 then 'standard' else credit_tier end").alias("credit_tier"),
        F.expr("case when user_id % 6 = 0 then cast(credit_limit * 2 as decimal(12,2)) else credit_limit end").alias("credit_limit"),
        "kyc_status",
    )


def _dim_now(d: Data):
    return d.users.where("user_id % 30 <> 11").select("user_id", *CHECKED)


def _snapshot(d: Data):
    first = scd2.scd2_check(_dim_then(d), None, "user_id", CHECKED, F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    return scd2.scd2_check(_dim_now(d), first, "user_id", CHECKED, F.lit("2001-05-01 00:00:00").cast("timestamp_ntz"))


SCD_CTE = """WITH a AS (SELECT user_id, CASE WHEN user_id % 9 = 0 THEN 'standard' ELSE credit_tier END AS credit_tier,
    CASE WHEN user_id % 6 = 0 THEN cast(credit_limit * 2 AS DECIMAL(12,2)) ELSE credit_limit END AS credit_limit,
    kyc_status FROM users WHERE user_id % 20 <> 7),
  b AS (SELECT user_id, credit_tier, credit_limit, kyc_status FROM users WHERE user_id % 30 <> 11),
  j AS (SELECT a.user_id AS ak, b.user_id AS bk, a.credit_tier AS a_tier, a.credit_limit AS al, a.kyc_status AS akyc,
    b.credit_tier AS bt, b.credit_limit AS bl, b.kyc_status AS bkyc,
    (a.credit_tier IS NOT DISTINCT FROM b.credit_tier AND a.credit_limit IS NOT DISTINCT FROM b.credit_limit
      AND a.kyc_status IS NOT DISTINCT FROM b.kyc_status) AS same FROM a FULL JOIN b ON a.user_id = b.user_id),
  snap AS (SELECT ak AS user_id, a_tier AS credit_tier, al AS credit_limit, akyc AS kyc_status, TIMESTAMP '2001-01-01' AS valid_from,
      CASE WHEN bk IS NULL OR NOT same THEN TIMESTAMP '2001-05-01' END AS valid_to FROM j WHERE ak IS NOT NULL
    UNION ALL SELECT bk, bt, bl, bkyc, TIMESTAMP '2001-05-01', NULL FROM j WHERE bk IS NOT NULL AND (ak IS NULL OR NOT same))"""
add("scd_01_check_snapshot", _snapshot, SCD_CTE + " SELECT * REPLACE (credit_limit::DOUBLE AS credit_limit) FROM snap")


@query(
    "scd_01_merchant_limits",
    """WITH a AS (SELECT merchant_id, credit_limit, risk_tier, commission_rate FROM merchants),
      b AS (SELECT merchant_id, credit_limit, CASE WHEN merchant_id % 4 = 0 THEN 'high' ELSE risk_tier END AS risk_tier,
        commission_rate FROM merchants)
    SELECT a.merchant_id, a.credit_limit::DOUBLE AS credit_limit, a.risk_tier, a.commission_rate::DOUBLE AS commission_rate,
      TIMESTAMP '2001-01-01' AS valid_from, CASE WHEN a.risk_tier <> b.risk_tier THEN TIMESTAMP '2001-05-01' END AS valid_to
      FROM a JOIN b USING (merchant_id)
    UNION ALL SELECT b.merchant_id, b.credit_limit::DOUBLE, b.risk_tier, b.commission_rate::DOUBLE, TIMESTAMP '2001-05-01', NULL
      FROM a JOIN b USING (merchant_id) WHERE a.risk_tier <> b.risk_tier""",
)
def _merchant_limits(d: Data):
    checked = ["credit_limit", "risk_tier", "commission_rate"]
    then = d.merchants.select("merchant_id", *checked)
    now = then.withColumn("risk_tier", F.when(F.col("merchant_id") % 4 == 0, "high").otherwise(F.col("risk_tier")))
    first = scd2.scd2_check(then, None, "merchant_id", checked, F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    return scd2.scd2_check(now, first, "merchant_id", checked, F.lit("2001-05-01 00:00:00").cast("timestamp_ntz"))


add(
    "scd_02_as_of",
    lambda d: scd2.scd2_as_of(
        _snapshot(d), d.tx.select("transaction_id", "user_id", "created_at"), "user_id", "created_at", ["credit_tier", "credit_limit"]
    ),
    SCD_CTE + """ SELECT t.transaction_id, t.user_id, t.created_at, s.valid_from, s.valid_to, s.credit_tier,
      s.credit_limit::DOUBLE AS credit_limit FROM transactions t LEFT JOIN snap s ON t.user_id = s.user_id
      AND t.created_at >= s.valid_from AND (s.valid_to IS NULL OR t.created_at < s.valid_to)""",
)
add(
    "scd_03_current", lambda d: scd2.scd2_current(_snapshot(d)).select("user_id", "credit_tier", "valid_from"),
    SCD_CTE + " SELECT user_id, credit_tier, valid_from FROM snap WHERE valid_to IS NULL",
)
add(
    "scd_04_from_log",
    lambda d: scd2.scd2_from_log(
        d.versions, domain.REPAYMENT_KEYS, ["status"], domain.REPAYMENT_VERSION_ORDER, "updated_at"
    ),
    """WITH o AS (SELECT *, op = 'd' AS gone, row_number() OVER w AS pos, lag(status) OVER w AS ps, lag(op = 'd') OVER w AS pg
      FROM repayment_versions WINDOW w AS (PARTITION BY transaction_id, installment_number
        ORDER BY updated_at, tie_part, tie_supp, amount, tie_qty)),
    starts AS (SELECT * FROM o WHERE pos = 1 OR status IS DISTINCT FROM ps OR gone IS DISTINCT FROM pg),
    spans AS (SELECT *, lead(updated_at) OVER (PARTITION BY transaction_id, installment_number ORDER BY pos) AS nxt FROM starts)
    SELECT transaction_id, installment_number, status, updated_at AS valid_from, nxt AS valid_to FROM spans WHERE NOT gone""",
)

# -- incremental ----------------------------------------------------------------------------------------------------


def _old_kpis(d: Data):
    """The mart as a run one week earlier left it."""
    newest = d.stg_tx.agg(F.to_date(F.max("created_at")).alias("m")).scalar()
    return d.stg_tx.where(F.to_date("created_at") <= F.date_sub(newest, 7)).groupBy(
        F.to_date("created_at").alias("date")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "inc_01_incremental_slice",
    """WITH t AS (SELECT max(created_at::DATE) AS m FROM stg_transactions
        WHERE created_at::DATE <= (SELECT max(created_at)::DATE FROM stg_transactions) - 7)
    SELECT merchant_id, created_at::DATE AS date, sum(amount)::DOUBLE AS gmv, count(*) AS transaction_count
      FROM stg_transactions, t WHERE created_at::DATE >= t.m - 3 GROUP BY ALL""",
)
def _slice(d: Data):
    """Only the recomputed days reach the mart."""
    part = incremental.incremental_slice(d.stg_tx, _old_kpis(d), "created_at", "3 days", "date")
    return marts.merchant_daily_kpis(part, d.merchants).select("merchant_id", "date", "gmv", "transaction_count")


@query(
    "inc_01_incremental_cohorts",
    """WITH m AS (SELECT max(cohort_month) AS c FROM cohorts)
    SELECT cohort_month, user_id, ltv::DOUBLE AS ltv FROM cohorts, m WHERE cohort_month >= c - INTERVAL 3 MONTH""",
)
def _cohort_slice(d: Data):
    return incremental.incremental_slice(d.cohorts, d.cohorts, "cohort_month", "3 months").select(
        "cohort_month", "user_id", "ltv"
    )


# money and buyers per month and merchant
MERCHANT_STATES = states.StateSpec(["merchant_id"], sums={"amount": "amount"}, distinct={"users": "user_id"})


@query(
    "inc_01_incremental_states",
    """SELECT merchant_id, count(*) AS rows, sum(amount)::DOUBLE AS sum_amount, true AS users_close FROM stg_transactions GROUP BY 1""",
)
def _state_slice(d: Data):
    """Stored states built up to an older day, then advanced by the slice of the months that can have changed; equals a full build."""
    path, month = shared_path(d.spark, "inc01-states"), F.date_format("created_at", "yyyyMM")
    first = d.stg_tx.where(F.col("created_at") < F.lit("2001-06-10").cast("timestamp_ntz"))
    states.replace_periods(states.build_states(first, month, MERCHANT_STATES), path)
    newest = states.read_states(d.spark, path).agg(F.max("period").alias("m")).scalar()
    states.replace_periods(states.build_states(d.stg_tx.where(month >= newest), month, MERCHANT_STATES), path)
    total = states.answers(states.merge_states(states.read_states(d.spark, path), MERCHANT_STATES), MERCHANT_STATES)
    exact = d.stg_tx.groupBy("merchant_id").agg(F.count_distinct("user_id").alias("_users"))
    return total.join(exact, "merchant_id").select(
        "merchant_id", "rows", "sum_amount", (F.abs(F.col("users") - F.col("_users")) <= F.greatest(F.col("_users") * states.hll_bound(), F.lit(1))).alias("users_close")
    )


@query("inc_02_refuse_schema_change", "SELECT 'refused' AS outcome, count(*) AS rows_kept FROM cohorts")
def _refuse(d: Data):
    """A write of a changed frame into a stored table is refused; what counts is what the table's files have afterwards."""
    path = shared_path(d.spark, "inc02")
    monthly = d.cohorts.withColumn("month", F.date_format("cohort_month", "yyyyMM"))
    sinks.delete_insert(d.spark, monthly, path, ["user_id"], ["month"])
    try:
        sinks.delete_insert(d.spark, monthly.withColumn("extra", F.lit(1)), path, ["user_id"], ["month"])
    except ValueError:
        pass
    files = stored.files_of({"cohorts": d.spark.read.parquet(path)})
    changed = F.count_if(F.exists("columns", lambda c: c["name"] == "extra")) > 0
    return files.agg(F.when(changed, "accepted").otherwise("refused").alias("outcome"), F.sum("file_rows").alias("rows_kept"))


@query(
    "inc_03_has_new_rows",
    """SELECT max(updated_at) > TIMESTAMP '2001-01-01' AS new_rows, max(updated_at) > TIMESTAMP '2031-01-01' AS future_rows
      FROM repayment_versions""",
)
def _new_rows(d: Data):
    later = incremental.new_rows(d.versions, "updated_at", "2031-01-01", "future_rows")
    return incremental.new_rows(d.versions, "updated_at", "2001-01-01").withColumn("future_rows", later.scalar())
