"""Dashboard, alert, service-level and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.base import AS_OF, Data, add, query
from tallyframe.catalog.features import METRICS_SQL, _metrics
from tallyframe.catalog.functions import DIMENSION_SQL, HOST_SQL, PATH_SQL, PERIOD_SQL, SOURCE_SQL, _dimension
from tallyframe.catalog.relational import RECON_SQL, RISK_SQL
from tallyframe.operators import asof, calendar_tables, cdc, scd2, setops
from tallyframe.operators.latest import latest_by
from tallyframe.operators.quantiles import exact_quantiles
from tallyframe.plans import drift, marts, monitoring, reports
from tallyframe.sinks import audit_events
from tallyframe.sources import changes, domain

T_AS_OF = f"TIMESTAMP '{AS_OF}'"
NTZ = "timestamp_ntz"


def at(text: str):
    return F.lit(text).cast(NTZ)


def audit(d: Data):
    """Pipeline runs derived from the event table: the type is the pipeline, each event one run."""
    return audit_events(
        d.events, F.col("created_at"), F.col("event_type"), F.lit("run"), F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 9 == 0, "failed").otherwise("success"), F.col("value"), ["user_id"],
    )


AUDIT = "(SELECT *, CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'success' END AS status FROM app_events)"

add("mon_01_kpi_table", lambda d: monitoring.kpi_table(d.kpis).select("merchant_id", "date", "gmv", "transaction_count"),
    "SELECT merchant_id, date, gmv::DOUBLE AS gmv, transaction_count FROM kpis")
add("mon_02_approval_series", lambda d: monitoring.approval_series(d.kpis),
    "SELECT date, merchant_id, round(approval_rate, 6) AS approval_rate FROM kpis")
add("mon_03_instalment_share", lambda d: monitoring.instalment_share(d.kpis),
    "SELECT round(avg(bnpl_penetration), 6) AS avg_bnpl_penetration FROM kpis")
add(
    "mon_04_decision_latency", lambda d: monitoring.decision_latency(d.tx, d.now, "30 days"),
    f"""SELECT round(median(decision_latency_ms), 6) AS p50, round(quantile_cont(decision_latency_ms, 0.95), 6) AS p95,
      round(quantile_cont(decision_latency_ms, 0.99), 6) AS p99 FROM transactions WHERE created_at >= {T_AS_OF} - INTERVAL 30 DAY""",
)


@query(
    "mon_04_decision_latency_approx", "SELECT true AS p50_close, true AS p95_close, true AS p99_close",
)
def _latency_close(d: Data):
    """The estimates lie between exact quantiles half a percent below and above."""
    near = monitoring.decision_latency(d.tx, d.now, "30 days", exact=False)
    rows = monitoring.recent(d.tx, "created_at", "30 days", d.now)
    probs = {f"{n}_{side}": q + s for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)) for side, s in (("lo", -0.005), ("hi", 0.005))}
    exact = exact_quantiles(rows, "decision_latency_ms", probs)
    return near.select(*[
        F.col(n).between(F.floor(exact.select(f"{n}_lo").scalar()), F.ceil(exact.select(f"{n}_hi").scalar())).alias(f"{n}_close")
        for n in ("p50", "p95", "p99")
    ])


add("mon_05_top_merchants", lambda d: monitoring.top_merchants(d.kpis),
    "SELECT merchant_id, sum(gmv)::DOUBLE AS total_gmv FROM kpis GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
add("mon_06_feature_table_health", lambda d: monitoring.feature_table_health(d.history),
    "SELECT feature_version, max(snapshot_ts) AS last_update, count(*) AS row_count FROM feature_history GROUP BY 1")
for _unit in ("minute", "hour"):
    add(
        f"mon_07_requests_per_{_unit}", lambda d, u=_unit: monitoring.request_rates(d.log, u),
        f"""SELECT date_trunc('{_unit}', event_time)::TIMESTAMP AS slot, count(*) AS requests,
          round(quantile_cont(latency_ms, 0.99), 6) AS p99 FROM request_log GROUP BY 1""",
    )
add("mon_08_drift_overview", lambda d: monitoring.drift_overview(_metrics(d)),
    f"""SELECT count(*) FILTER (is_drifted = 1) AS drifted, round(max(drift_score), 6) AS max_score,
      max(measured_at) AS last_measured FROM ({METRICS_SQL})""")
add("mon_09_ingest_lag", lambda d: monitoring.staleness(d.tx, "created_at", at("2001-08-02 07:31:00"), "minute", "lag_minutes"),
    "SELECT date_diff('minute', max(created_at), TIMESTAMP '2001-08-02 07:31:00') AS lag_minutes FROM transactions")


@query(
    "mon_10_newest_results",
    """SELECT (event_id % 9 = 0) AS failed, event_time, run_id FROM (SELECT event_id, created_at AS event_time,
      event_id::VARCHAR AS run_id FROM app_events ORDER BY created_at DESC, event_id::VARCHAR LIMIT 10)""",
)
def _newest_results(d: Data):
    return monitoring.newest(audit(d), "event_time", 10, "run_id").select(
        (F.col("status") == "failed").alias("failed"), "event_time", "run_id"
    )


add("mon_11_feature_freshness", lambda d: monitoring.freshness_status(d.history, "snapshot_ts", at("2001-08-01 05:00:00"), 6),
    """SELECT h AS hours_stale, CASE WHEN h < 6 THEN 'PASS' ELSE 'FAIL' END AS status
      FROM (SELECT date_diff('hour', max(snapshot_ts), TIMESTAMP '2001-08-01 05:00:00') AS h FROM feature_history)""")
add("mon_12_settlement_last_days", lambda d: monitoring.newest(marts.settlement_summary(d.recon), "settlement_date", 5),
    """SELECT settlement_date, count(DISTINCT merchant_id) AS merchants, count(*) FILTER (status = 'matched') AS matched,
      count(*) FILTER (status = 'mismatch') AS mismatches, round(avg(variance_pct), 6) AS avg_variance_pct
      FROM recon GROUP BY 1 ORDER BY 1 DESC LIMIT 5""")
add(
    "mon_13_slo_table",
    lambda d: monitoring.slo_table(d.features, d.log, d.kpis, d.tx, d.recon, _metrics(d), d.now),
    f"""SELECT name, target, round(v::DOUBLE, 6) AS measured_value, coalesce(met, false) AS met FROM (
      SELECT 'feature_freshness' AS name, '< 6 hours' AS target, date_diff('hour', max(snapshot_ts), {T_AS_OF})::DOUBLE AS v, v < 6 AS met FROM features
      UNION ALL SELECT 'feature_read_p99', '< 50 ms', quantile_cont(latency_ms, 0.99), quantile_cont(latency_ms, 0.99) < 50 FROM request_log
      UNION ALL SELECT 'mart_freshness', '< 25 hours', date_diff('hour', max(date)::TIMESTAMP, {T_AS_OF}), date_diff('hour', max(date)::TIMESTAMP, {T_AS_OF}) < 25 FROM kpis
      UNION ALL SELECT 'ingestion_latency', '< 30 seconds', date_diff('second', max(created_at), {T_AS_OF}), date_diff('second', max(created_at), {T_AS_OF}) < 30 FROM transactions
      UNION ALL SELECT 'settlement_reconciliation', 'by 6 AM', count(*) FILTER (settlement_date = {T_AS_OF}::DATE), count(*) FILTER (settlement_date = {T_AS_OF}::DATE) > 0 FROM recon
      UNION ALL SELECT 'drift_detection', '< 60 minutes', date_diff('minute', max(measured_at), {T_AS_OF}), date_diff('minute', max(measured_at), {T_AS_OF}) < 60 FROM ({METRICS_SQL}))""",
)

# -- alerts ----------------------------------------------------------------------------------------------------


def _alert_sql(measure: str, test: str, severity: str, src: str) -> str:
    return f"SELECT m::DOUBLE AS measure, '{severity}' AS severity, coalesce(m {test}, false) AS firing FROM (SELECT {measure} AS m FROM {src})"


add(
    "alert_01_approval_rate_drop", lambda d: monitoring.approval_rate_drop(d.stg_tx, at("2001-03-01 12:30:00")),
    """SELECT round(b.r - c.r, 6) AS measure, 'warning' AS severity, coalesce(b.r - c.r > 15, false) AS firing
      FROM (SELECT count(*) FILTER (status = 'approved') * 100.0::DOUBLE / nullif(count(*), 0) AS r FROM stg_transactions
            WHERE created_at >= TIMESTAMP '2001-03-01 12:30:00' - INTERVAL 24 HOUR) b,
           (SELECT count(*) FILTER (status = 'approved') * 100.0::DOUBLE / nullif(count(*), 0) AS r FROM stg_transactions
            WHERE created_at >= TIMESTAMP '2001-03-01 12:30:00' - INTERVAL 1 HOUR) c""",
)
add(
    "alert_02_failed_checks",
    lambda d: monitoring.count_alert(
        audit(d), (F.col("status") == "failed") & (F.col("event_time") > at("2024-01-30 23:00:00") - F.expr("interval 1 hour")), 0, "critical"
    ),
    _alert_sql("count(*) FILTER (status = 'failed' AND created_at > TIMESTAMP '2024-01-30 22:00:00')", "> 0", "critical", AUDIT),
)
add(
    "alert_03_drifted_features",
    lambda d: monitoring.count_alert(_metrics(d), F.col("is_drifted") == 1, 0, "warning"),
    _alert_sql("count(*) FILTER (is_drifted = 1)", "> 0", "warning", f"({METRICS_SQL})"),
)
add(
    "alert_04_features_stale",
    lambda d: monitoring.staleness_alert(d.history, "snapshot_ts", at("2001-08-01 09:00:00"), "hour", 6, "critical"),
    _alert_sql("date_diff('hour', max(snapshot_ts), TIMESTAMP '2001-08-01 09:00:00')", "> 6", "critical", "feature_history"),
)
add(
    "alert_05_ingestion_flatline",
    lambda d: monitoring.flatline_alert(d.events, "created_at", at("2024-01-30 23:59:00")),
    _alert_sql("count(*) FILTER (created_at >= TIMESTAMP '2024-01-30 23:54:00')", "< 1", "critical", "app_events"),
)
add(
    "alert_06_ingest_lag",
    lambda d: monitoring.staleness_alert(d.events, "created_at", at("2024-01-31 01:30:00"), "minute", 60, "warning"),
    _alert_sql("date_diff('minute', max(created_at), TIMESTAMP '2024-01-31 01:30:00')", "> 60", "warning", "app_events"),
)
add(
    "alert_07_failed_runs",
    lambda d: monitoring.count_alert(audit(d), (F.col("status") == "failed") & (F.col("event_time") > at("2024-01-30 12:00:00")), 0, "critical"),
    _alert_sql("count(*) FILTER (status = 'failed' AND created_at > TIMESTAMP '2024-01-30 12:00:00')", "> 0", "critical", AUDIT),
)
add(
    "alert_08_settlement_mismatch",
    lambda d: monitoring.count_alert(
        d.recon, (F.col("status") == "mismatch") & (F.col("settlement_date") == F.lit("2000-06-01").cast("date")), 0, "critical"
    ),
    _alert_sql("count(*) FILTER (status = 'mismatch' AND settlement_date = DATE '2000-06-01')", "> 0", "critical", "recon"),
)

# -- reports -------------------------------------------------------------------------------------------------------

add(
    "rpt_01_latest_run_status", lambda d: reports.latest_run_status(audit(d)),
    f"""SELECT event_type AS dag_id, max(created_at) AS last_event, arg_max(status, (created_at, event_id::VARCHAR)) AS status,
      count(*) AS runs FROM {AUDIT} GROUP BY 1""",
)
add("rpt_02_layer_counts", lambda d: setops.labelled_counts({"transactions": d.tx, "repayments": d.repay, "users": d.users}),
    """SELECT 'transactions' AS layer, count(*) AS row_count FROM transactions UNION ALL SELECT 'repayments', count(*) FROM repayments
      UNION ALL SELECT 'users', count(*) FROM users""")
add(
    "rpt_02_dedup_count",
    lambda d: d.versions.agg(F.count(F.lit(1)).alias("versions")).withColumn(
        "current_rows", latest_by(d.versions, domain.REPAYMENT_KEYS, domain.REPAYMENT_VERSION_ORDER).agg(F.count(F.lit(1)).alias("n")).scalar()
    ),
    "SELECT count(*) AS versions, (SELECT count(*) FROM repayments) AS current_rows FROM repayment_versions",
)
add(
    "rpt_02_point_in_time",
    lambda d: asof.asof_join(
        d.users.select("user_id", at("2001-05-10 00:00:00").alias("as_of")), d.history, ["user_id"], "as_of",
        "valid_from", "valid_to", ["tx_velocity_30d"], ["snapshot_ts"],
    ),
    """SELECT u.user_id, TIMESTAMP '2001-05-10' AS as_of, f.valid_from, f.valid_to, f.tx_velocity_30d FROM users u
      LEFT JOIN feature_history f ON u.user_id = f.user_id AND f.valid_from <= TIMESTAMP '2001-05-10' AND f.valid_to > TIMESTAMP '2001-05-10'""",
)
add(
    "rpt_02_exposure",
    lambda d: marts.merge_exposure(marts.exposure_partials(d.tx, F.lit(0))).orderBy(F.desc("active_exposure"), "user_id").limit(10),
    "SELECT user_id, sum(amount)::DOUBLE AS active_exposure FROM transactions WHERE status = 'approved' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
add("rpt_02_risk", lambda d: monitoring.newest(d.risk, "date", 30), RISK_SQL + " ORDER BY date DESC LIMIT 30")
add("rpt_02_settlement", lambda d: d.recon.where("status = 'mismatch'"), RECON_SQL + " WHERE status = 'mismatch'")
add(
    "rpt_02_scd2_current",
    lambda d: scd2.scd2_current(scd2.scd2_from_log(
        d.versions, domain.REPAYMENT_KEYS, ["status"], domain.REPAYMENT_VERSION_ORDER, "updated_at"
    )).select("transaction_id", "installment_number", "status"),
    "SELECT transaction_id, installment_number, CASE op WHEN 'u' THEN 'PAID' ELSE 'waived' END AS status FROM repayments WHERE op <> 'd'",
)
add("rpt_02_drift", lambda d: drift.latest_drift(_metrics(d)).select("feature_name", "status"),
    f"SELECT feature_name, CASE WHEN drift_score > 3.0 THEN 'EXCEEDED' ELSE 'OK' END AS status FROM ({METRICS_SQL})")
add("rpt_02_cohorts", lambda d: marts.cohort_summary(d.cohorts),
    """SELECT cohort_month, count(*) AS users, round(avg(ltv::DOUBLE), 6) AS avg_ltv, round(avg(retention_months), 6) AS avg_retention
      FROM cohorts GROUP BY 1""")
add(
    "rpt_02_deletes_per_table",
    lambda d: cdc.delete_audit({
        "transactions": (changes.transaction_events(d.tx), "transaction_id"),
        "repayments": (changes.repayment_events(d.versions), "repayment_id"),
    }).groupBy("source_table").agg(F.count(F.lit(1)).alias("deletes")),
    """SELECT 'transactions' AS source_table, count(*) AS deletes FROM transactions WHERE transaction_id % 10 = 0
      UNION ALL SELECT 'repayments', count(*) FROM repayment_versions WHERE op = 'd'""",
)
add(
    "rpt_03_query_mix", lambda d: reports.consumption_mix(d.tx, d.stg_tx, d.kpis, _metrics(d), at("2001-07-31 00:00:00")),
    f"""SELECT 'raw_rows' AS query, NULL::VARCHAR AS key, count(*)::DOUBLE AS value FROM transactions
      UNION ALL SELECT 'tx_per_merchant', merchant_id::VARCHAR, count(*)::DOUBLE FROM stg_transactions GROUP BY merchant_id
      UNION ALL SELECT 'recent_amount', NULL, sum(amount)::DOUBLE FROM stg_transactions WHERE created_at >= TIMESTAMP '2001-07-30'
      UNION ALL SELECT 'avg_mart_gmv', NULL, round(avg(gmv::DOUBLE), 6) FROM kpis
      UNION ALL SELECT 'avg_drift', feature_name, round(avg(drift_score), 6) FROM ({METRICS_SQL}) GROUP BY feature_name""",
)
add(
    "rpt_04_web_attribution", lambda d: reports.web_attribution(d.raw("pages")),
    f"""SELECT host, source, count(*) AS pages, count(DISTINCT path) AS paths FROM (SELECT {HOST_SQL} AS host, {PATH_SQL} AS path,
      {SOURCE_SQL} AS source FROM pages) GROUP BY 1, 2""",
)
_LAT, _LON = "(user_id * 7 + event_id) % 170 - 85.0", "(user_id * 13 + event_id * 3) % 360 - 180.0"


@query(
    "rpt_05_movement",
    f"""SELECT event_id, round(2 * 3961 * asin(sqrt(power(sin(radians((la - pa) / 2)), 2) + cos(radians(pa)) * cos(radians(la)) *
      power(sin(radians((lo - po) / 2)), 2))) * 1.60934, 3) AS distance_km FROM (
      SELECT event_id, la, lo, lag(la) OVER w AS pa, lag(lo) OVER w AS po FROM (SELECT event_id, user_id, created_at,
      ({_LAT})::DOUBLE AS la, ({_LON})::DOUBLE AS lo FROM app_events)
      WINDOW w AS (PARTITION BY user_id ORDER BY created_at, event_id)) WHERE pa IS NOT NULL""",
)
def _movement(d: Data):
    """Positions travel as single-quoted JSON in the payload, as the newest payload version has them."""
    payload = F.format_string(
        "{'page': 'home', 'referrer': 'ad', 'geo': {'lat': %s, 'lon': %s}}",
        F.expr(_LAT).cast("double").cast("string"), F.expr(_LON).cast("double").cast("string"),
    )
    events = cdc.parse_event_data(d.events.withColumn("event_data", payload)).select(
        "event_id", "user_id", "created_at", "geo_lat", "geo_lon"
    )
    return reports.movement(events, ["user_id"], ["created_at", "event_id"]).select(
        "event_id", F.round("distance_km", 3).alias("distance_km")
    )


@query(
    "rpt_06_calendar_kpis",
    f"""WITH dimension AS ({DIMENSION_SQL}), fiscal AS ({PERIOD_SQL}),
    daily AS (SELECT date, sum(gmv) AS gmv, sum(transaction_count)::BIGINT AS transaction_count FROM kpis GROUP BY 1)
    SELECT c.prior_year_over_year_date_day, a.date, a.gmv::DOUBLE AS gmv, a.transaction_count, c.iso_week_of_year,
      c.day_of_week_name_short, f.fiscal_year_number, f.fiscal_period_number, b.gmv::DOUBLE AS prior_year_gmv
    FROM daily a JOIN dimension c ON a.date = c.date_day LEFT JOIN fiscal f ON a.date = f.date_day
    LEFT JOIN daily b ON b.date = c.prior_year_over_year_date_day""",
)
def _calendar(d: Data):
    dates = _dimension(d)
    return reports.kpis_by_calendar(d.kpis, dates, calendar_tables.fiscal_periods(dates, year_end_month=1))
