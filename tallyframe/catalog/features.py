"""Feature, drift and quality queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe import contracts as K
from tallyframe.catalog.base import AS_OF, Data, add, query
from tallyframe.checks import contracts, project, runner, stored
from tallyframe.checks.generic import missing_days
from tallyframe.functions.scalars import clamp_far_future
from tallyframe.operators import asof, quantiles, states
from tallyframe.operators.tables import unpivot
from tallyframe.plans import drift, features
from tallyframe.plans.features import FEATURE_NAMES
from tallyframe.sources import changes

T_AS_OF = f"TIMESTAMP '{AS_OF}'"


def feature_sql(src: str) -> str:
    return f"""SELECT user_id, snapshot_ts, valid_from, valid_to, feature_version, tx_velocity_7d, tx_velocity_30d,
      avg_tx_amount_30d::DOUBLE AS avg_tx_amount_30d, round(repayment_rate_90d, 6) AS repayment_rate_90d,
      merchant_diversity_30d, round(declined_rate_7d, 6) AS declined_rate_7d, active_installments,
      days_since_first_tx FROM {src}"""


_ROUNDED = {"avg_tx_amount_30d": "avg_tx_amount_30d::DOUBLE", "repayment_rate_90d": "round(repayment_rate_90d, 6)",
            "declined_rate_7d": "round(declined_rate_7d, 6)"}
for _i, _f in enumerate(
    ["tx_velocity_7d", "tx_velocity_30d", "avg_tx_amount_30d", "merchant_diversity_30d", "declined_rate_7d",
     "repayment_rate_90d", "active_installments", "days_since_first_tx"], 1
):
    add(
        f"feat_{_i:02d}_{_f}", lambda d, f=_f: d.features.select("user_id", f),
        f"SELECT user_id, {_ROUNDED.get(_f, _f)} AS {_f} FROM features",
    )
add(
    "feat_09_fill_defaults",
    lambda d: features.fill_defaults(
        features.transaction_features(d.stg_tx, features.as_column(AS_OF)).join(
            features.repayment_features(d.repay, features.as_column(AS_OF)), "user_id", "left"
        )
    ).select("user_id", "repayment_rate_90d", "avg_tx_amount_30d"),
    """SELECT user_id, round(repayment_rate_90d, 6) AS repayment_rate_90d, avg_tx_amount_30d::DOUBLE AS avg_tx_amount_30d
      FROM features""",
)
add(
    "feat_10_stamp_validity",
    lambda d: features.stamp_validity(d.users.select("user_id"), features.as_column(AS_OF), 4, "v2"),
    f"""SELECT user_id, {T_AS_OF} AS snapshot_ts, {T_AS_OF} AS valid_from, {T_AS_OF} + INTERVAL 4 HOUR AS valid_to,
      'v2' AS feature_version FROM users""",
)
add("feat_11_compute_features", lambda d: d.features, feature_sql("features"))
add("feat_12_feature_history", lambda d: d.computed_history, feature_sql("feature_history"))


@query(
    "feat_13_serve_as_of",
    """WITH hit AS (SELECT r.*, f.valid_from AS vf, f.valid_to AS vt, f.tx_velocity_30d AS v, f.declined_rate_7d AS dr
      FROM requests r ASOF LEFT JOIN feature_history f ON r.user_id = f.user_id AND r.as_of >= f.valid_from),
    newest AS (SELECT * FROM feature_history QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC) = 1)
    SELECT request_id, h.user_id, as_of, CASE WHEN vt > as_of THEN vf ELSE n.valid_from END AS valid_from,
      CASE WHEN vt > as_of THEN v ELSE n.tx_velocity_30d END AS tx_velocity_30d,
      round(CASE WHEN vt > as_of THEN dr ELSE n.declined_rate_7d END, 6) AS declined_rate_7d,
      CASE WHEN vt > as_of THEN 'as_of' WHEN n.user_id IS NOT NULL THEN 'latest' ELSE 'none' END AS match,
      CASE WHEN n.user_id IS NOT NULL THEN true END AS is_valid
    FROM hit h LEFT JOIN newest n ON h.user_id = n.user_id""",
)
def _serve(d: Data):
    return features.serve_as_of(d.requests, d.history, "v1").select(
        "request_id", "user_id", "as_of", "valid_from", "tx_velocity_30d", "declined_rate_7d", "match", "is_valid"
    )


@query(
    "feat_14_clamp_far_future",
    f"""SELECT transaction_id, CASE WHEN transaction_id % 100 = 1 THEN {T_AS_OF} ELSE created_at END AS created_at
      FROM transactions""",
)
def _clamp(d: Data):
    """One in a hundred times lies in the year 2299 and counts as now."""
    far = F.when(F.col("transaction_id") % 100 == 1, F.lit("2299-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("created_at"))
    return d.tx.select("transaction_id", clamp_far_future(far, d.now).alias("created_at"))


@query("feat_15_feature_config", "SELECT feature_name, sum(v)::DOUBLE AS total FROM (UNPIVOT (SELECT " + ", ".join(
    f"{n}::DOUBLE AS {n}" for n in FEATURE_NAMES) + " FROM features) ON " + ", ".join(FEATURE_NAMES)
    + " INTO NAME feature_name VALUE v) GROUP BY 1 HAVING feature_name NOT LIKE '%rate%'")
def _config(d: Data):
    """Totals of every feature the configuration lists as a count or an amount."""
    names = [n for n, f in features.FEATURES.items() if f["kind"] != "rate"]
    wide = d.features.agg(*[F.sum(n).cast("double").alias(n) for n in names])
    return wide.unpivot([], names, "feature_name", "total")


add(
    "src_05_derive_snapshot_ts", lambda d: features.derive_snapshot_ts(d.tx, d.now),
    "SELECT max(created_at) AS snapshot_ts FROM transactions",
)

# -- drift ------------------------------------------------------------------------------------------------------

LONG = "(UNPIVOT (SELECT " + ", ".join(f"{n}::DOUBLE AS {n}" for n in FEATURE_NAMES) + " FROM {src}) ON " + ", ".join(
    FEATURE_NAMES
) + " INTO NAME feature_name VALUE value)"
QUART = "SELECT feature_name, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3 FROM {long} GROUP BY 1"
add(
    "drift_01_feature_quartiles", lambda d: drift.feature_quartiles(d.features),
    f"SELECT feature_name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3 FROM ({QUART.format(long=LONG.format(src='features'))})",
)
# the newest snapshot against the newest one that is half a year older
BASELINE_DAYS = 180
NEW = "(SELECT max(snapshot_ts) FROM feature_history)"
OLD = f"(SELECT max(snapshot_ts) FROM feature_history WHERE snapshot_ts <= {NEW} - INTERVAL {BASELINE_DAYS} DAY)"


def _sides(d: Data):
    at = F.col("snapshot_ts")
    newest = d.history.agg(F.max("snapshot_ts").alias("m")).scalar()
    before = d.history.where(at <= newest - F.expr(f"interval {BASELINE_DAYS} days")).agg(F.max("snapshot_ts").alias("m")).scalar()
    return d.history.where(at == before), d.history.where(at == newest)


def _metrics(d: Data):
    old, new = _sides(d)
    return drift.drift_scores(old, new, d.now)


def _side_sql(ts: str) -> str:
    return QUART.format(long=LONG.format(src=f"(SELECT * FROM feature_history WHERE snapshot_ts = {ts})"))


METRICS_SQL = f"""SELECT b.feature_name, coalesce(abs(c.median - b.median) / nullif(b.q3 - b.q1, 0), 0.0) AS drift_score,
  CASE WHEN coalesce(abs(c.median - b.median) / nullif(b.q3 - b.q1, 0), 0.0) > 3.0 THEN 1 ELSE 0 END AS is_drifted,
  b.median AS baseline_median, c.median AS current_median, {T_AS_OF} AS measured_at
  FROM ({_side_sql(OLD)}) b JOIN ({_side_sql(NEW)}) c ON b.feature_name = c.feature_name"""
add(
    "drift_02_scores", _metrics,
    f"""SELECT feature_name, round(drift_score, 6) AS drift_score, is_drifted, round(baseline_median, 6) AS baseline_median,
      round(current_median, 6) AS current_median, measured_at FROM ({METRICS_SQL})""",
)


def _psi_sql() -> str:
    b = LONG.format(src=f"(SELECT * FROM feature_history WHERE snapshot_ts = {OLD})")
    c = LONG.format(src=f"(SELECT * FROM feature_history WHERE snapshot_ts = {NEW})")
    probs = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""WITH b AS (SELECT * FROM {b}), c AS (SELECT * FROM {c}),
      e AS (SELECT feature_name, list_distinct(quantile_cont(value, [{probs}])) AS edges FROM b GROUP BY 1),
      v AS (SELECT feature_name, value, 1 AS nb, 0 AS nc FROM b UNION ALL SELECT feature_name, value, 0, 1 FROM c),
      bins AS (SELECT v.feature_name, len(list_filter(e.edges, lambda x: x < v.value)) AS bin, sum(nb) AS nb, sum(nc) AS nc
        FROM v JOIN e ON v.feature_name = e.feature_name GROUP BY 1, 2),
      s AS (SELECT *, greatest(nc::DOUBLE / sum(nc) OVER (PARTITION BY feature_name), 0.0001) AS p,
        greatest(nb::DOUBLE / sum(nb) OVER (PARTITION BY feature_name), 0.0001) AS q FROM bins)
      SELECT feature_name, round(sum((p - q) * ln(p / q)), 6) AS psi, count(*) AS bins FROM s GROUP BY 1"""


add("drift_03_psi", lambda d: drift.psi(*_sides(d)), _psi_sql())


def _sketches(d: Data):
    """The sketch table of all snapshots, written once beside the feature table."""
    return d.stored("feature-sketches", lambda: drift.feature_sketches(d.history))


@query("drift_01_stored_quartiles", f"SELECT feature_name, true AS close FROM ({QUART.format(long=LONG.format(src='feature_history'))})")
def _stored_quartiles(d: Data):
    """Quartiles over all snapshots from the stored sketches, between the exact ones a rank error below and above."""
    bound = states.kll_bound() + 1e-9
    merged = _sketches(d).groupBy("feature_name").agg(F.kll_merge_agg_double("sketch", states.KLL_K).alias("_s"))
    near = merged.select("feature_name", *[F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(n) for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])
    probs = {f"{n}_{side}": q + sign * bound for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)) for side, sign in (("lo", -1), ("hi", 1))}
    long = unpivot(d.history.select(*FEATURE_NAMES), [], FEATURE_NAMES, "double", "feature_name", "value")
    exact = quantiles.exact_quantiles(long, "value", probs, ["feature_name"])
    close = F.lit(True)
    for n in ("q1", "q2", "q3"):
        close = close & F.col(n).between(F.floor(f"{n}_lo"), F.ceil(f"{n}_hi"))
    return near.join(exact, "feature_name").select("feature_name", close.alias("close"))


@query("drift_03_psi_from_sketches", "SELECT DISTINCT feature_name, true AS shares_close FROM " + LONG.format(src="feature_history"))
def _psi_sketches(d: Data):
    """Every bin's share from sketches is within its stated error of the share counted over the rows."""
    at = F.col("snapshot_ts")
    sketches, rows = _sketches(d), d.history
    newest = sketches.agg(F.max("snapshot_ts").alias("m")).scalar()
    before = sketches.where(at <= newest - F.expr(f"interval {BASELINE_DAYS} days")).agg(F.max("snapshot_ts").alias("m")).scalar()
    near = drift.psi_from_sketches(sketches.where(at == before), sketches.where(at == newest))
    sides = unpivot(rows.where((at == before) | (at == newest)).select("snapshot_ts", *FEATURE_NAMES), ["snapshot_ts"], FEATURE_NAMES, "double", "feature_name", "value")
    binned = sides.join(F.broadcast(near), "feature_name").withColumn("_bin", F.size(F.filter("edges", lambda e: e < F.col("value"))))
    total = Window.partitionBy("feature_name", "snapshot_ts")
    counted = binned.groupBy("feature_name", "snapshot_ts", "_bin", "shares_baseline", "shares_current").agg(F.count(F.lit(1)).alias("_n"))
    shares = counted.withColumn("_share", F.col("_n") / F.sum("_n").over(total))
    stored = F.when(at == before, F.get("shares_baseline", F.col("_bin"))).otherwise(F.get("shares_current", F.col("_bin")))
    return shares.groupBy("feature_name").agg(
        F.bool_and(F.abs(stored - F.col("_share")) <= drift.share_bound()).alias("shares_close")
    )


add(
    "drift_04_latest_status", lambda d: drift.latest_drift(_metrics(d)).select("feature_name", "drift_score", "status"),
    f"""SELECT feature_name, round(drift_score, 6) AS drift_score,
      CASE WHEN drift_score > 3.0 THEN 'EXCEEDED' ELSE 'OK' END AS status FROM ({METRICS_SQL})""",
)

# -- quality ------------------------------------------------------------------------------------------------------


def _dirty(d: Data):
    """Feature rows with planted faults: missing, negative, above one, misordered, inverted validity."""
    u = F.col("user_id")
    return d.features.withColumns({
        "avg_tx_amount_30d": F.when(u % 31 == 0, None).otherwise(F.col("avg_tx_amount_30d")),
        "active_installments": F.when(u % 37 == 0, -1).otherwise(F.col("active_installments")),
        "repayment_rate_90d": F.when(u % 41 == 0, 1.5).otherwise(F.col("repayment_rate_90d")),
        "tx_velocity_7d": F.when(u % 43 == 0, F.col("tx_velocity_30d") + 1).otherwise(F.col("tx_velocity_7d")),
        "valid_to": F.when(u % 47 == 0, F.col("valid_from")).otherwise(F.col("valid_to")),
    })


DIRTY = """(SELECT * REPLACE (CASE WHEN user_id % 31 <> 0 THEN avg_tx_amount_30d END AS avg_tx_amount_30d,
  CASE WHEN user_id % 37 = 0 THEN -1 ELSE active_installments END AS active_installments,
  CASE WHEN user_id % 41 = 0 THEN 1.5 ELSE repayment_rate_90d END AS repayment_rate_90d,
  CASE WHEN user_id % 43 = 0 THEN tx_velocity_30d + 1 ELSE tx_velocity_7d END AS tx_velocity_7d,
  CASE WHEN user_id % 47 = 0 THEN valid_from ELSE valid_to END AS valid_to) FROM features)"""
MISSING = "user_id % 31 = 0"
VALID = "NOT (user_id % 31 = 0 OR user_id % 37 = 0 OR user_id % 41 = 0)"

add(
    "dq_01_null_counts", lambda d: project.null_counts(_dirty(d)),
    " UNION ALL ".join(
        f"SELECT '{n}' AS feature_name, count(*) FILTER ({n} IS NULL) AS null_rows FROM {DIRTY}" for n in FEATURE_NAMES
    ),
)
add(
    "dq_02_velocity", lambda d: project.feature_gate(_dirty(d)).select("rows_checked", "velocity_rows"),
    f"SELECT count(*) AS rows_checked, count(*) FILTER (tx_velocity_30d < tx_velocity_7d) AS velocity_rows FROM {DIRTY}",
)
add(
    "dq_03_rate_range", lambda d: project.feature_gate(_dirty(d)).select("rows_checked", "rate_rows"),
    f"SELECT count(*) AS rows_checked, count(*) FILTER (repayment_rate_90d NOT BETWEEN 0 AND 1) AS rate_rows FROM {DIRTY}",
)
add(
    "dq_04_validity", lambda d: project.feature_gate(_dirty(d)).select("validity_rows", "passed"),
    f"SELECT count(*) FILTER (valid_to <= valid_from) AS validity_rows, false AS passed FROM {DIRTY}",
)
add(
    "dq_05_validate_features", lambda d: project.validate_features(_dirty(d), d.now).drop("details"),
    " UNION ALL ".join(
        f"""SELECT {T_AS_OF} AS check_time, 'feature_store' AS stage, '{n}' AS check_name, '{t}' AS check_type,
        CASE WHEN count(*) FILTER ({c}) = 0 THEN 'pass' ELSE '{bad}' END AS status, count(*) AS rows_checked,
        count(*) FILTER ({c}) AS rows_failed FROM {DIRTY}"""
        for n, t, c, bad in [
            ("null_check", "completeness", "avg_tx_amount_30d IS NULL", "fail"),
            ("range_check_non_negative", "validity", "active_installments < 0", "warn"),
            ("range_check_rates", "validity", "repayment_rate_90d > 1", "warn"),
            ("velocity_ordering", "consistency", "tx_velocity_30d < tx_velocity_7d", "warn"),
        ]
    ),
)
add("dq_05_rejects", lambda d: project.split_valid(_dirty(d))[1].select("user_id"), f"SELECT user_id FROM features WHERE NOT ({VALID})")
add("dq_05_valid_rows", lambda d: project.split_valid(_dirty(d))[0].select("user_id"), f"SELECT user_id FROM features WHERE {VALID}")
add(
    "dq_06_silver_gate", lambda d: project.silver_gate(d.tx, d.repay),
    """SELECT 'negative_amounts' AS check_name, count(*) FILTER (amount < 0) AS rows_failed,
      count(*) FILTER (amount < 0) = 0 AS passed FROM transactions UNION ALL
      SELECT 'unknown_repayment_status', count(*) FILTER (status NOT IN ('paid', 'overdue', 'waived', 'pending')),
      count(*) FILTER (status NOT IN ('paid', 'overdue', 'waived', 'pending')) = 0 FROM repayments""",
)
RESULT = "check_time, stage, check_name, check_type, status, rows_checked, rows_failed"


def _coverage_sql(stage: str, name: str, kind: str) -> str:
    return f"""SELECT {T_AS_OF} AS check_time, '{stage}' AS stage, '{name}' AS check_name, '{kind}' AS check_type,
      CASE WHEN f.n / u.n >= 0.95 THEN 'pass' WHEN f.n / u.n >= 0.80 THEN 'warn' ELSE 'fail' END AS status,
      u.n AS rows_checked, abs(u.n - f.n) AS rows_failed FROM (SELECT count(*) AS n FROM users) u,
      (SELECT count(DISTINCT user_id) AS n FROM features) f"""


add(
    "dq_07_feature_completeness", lambda d: project.feature_completeness(d.users, d.features, d.now).drop("details"),
    _coverage_sql("feature_store", "completeness_check", "completeness"),
)
add(
    "dq_08_feature_nulls", lambda d: project.feature_nulls(_dirty(d), d.now).drop("details"),
    f"""SELECT {T_AS_OF} AS check_time, 'feature_store' AS stage, 'null_check' AS check_name, 'completeness' AS check_type,
      'fail' AS status, count(*) AS rows_checked, count(*) FILTER ({MISSING}) AS rows_failed FROM features""",
)


def _gold(d: Data):
    return project.gold_completeness(
        {"merchant_daily_kpis": (d.kpis, 200), "user_cohorts": (d.cohorts, 49000), "settlement_reconciliation": (d.recon, 200)}, d.now
    )


add(
    "dq_09_gold_completeness", lambda d: _gold(d).drop("details"),
    f"""SELECT {T_AS_OF} AS check_time, 'gold' AS stage, 'gold_completeness_check' AS check_name, 'completeness' AS check_type,
      CASE WHEN sum((n < least_rows)::INT) = 0 THEN 'pass' ELSE 'fail' END AS status, sum(n)::BIGINT AS rows_checked,
      sum((n < least_rows)::INT)::BIGINT AS rows_failed FROM (SELECT count(*) AS n, 200 AS least_rows FROM kpis
      UNION ALL SELECT count(*), 49000 FROM cohorts UNION ALL SELECT count(*), 200 FROM recon)""",
)
add(
    "dq_10_gold_feature_reconciliation",
    lambda d: project.gold_feature_reconciliation(d.users, d.features, d.now, exact=True).drop("details"),
    _coverage_sql("gold", "gold_feature_reconciliation", "reconciliation"),
)
add("dq_10_reconciliation_approx", lambda d: project.gold_feature_reconciliation(d.users, d.features, d.now).drop("details"))


def _results(d: Data):
    tables = {
        "transactions": d.tx, "repayments": d.silver_repay, "users": d.users, "merchants": d.merchants,
        "installments": d.schedules,
    }
    return runner.declared_checks(tables, project.SILVER_CHECKS, d.now)


def _declared_sql() -> str:
    names = {t: t for t in ("transactions", "repayments", "users", "merchants", "installments")}
    head = f"SELECT {T_AS_OF} AS check_time, 'silver' AS stage, "
    parts = []
    for s in project.SILVER_CHECKS:
        tests = [("not_null", c, f"{c} IS NULL") for c in s.not_null]
        tests += [
            ("accepted_values", c, f"{c} NOT IN (" + ", ".join(f"'{v}'" for v in vs) + ")")
            for c, vs in s.accepted_values.items()
        ]
        for kind, c, bad in tests:
            parts.append(
                f"{head}'{s.table}.{c}' AS check_name, '{kind}' AS check_type, CASE WHEN count(*) FILTER ({bad}) = 0 "
                f"THEN 'pass' ELSE 'fail' END AS status, count(*) AS rows_checked, count(*) FILTER ({bad}) AS rows_failed FROM {names[s.table]}"
            )
        for c, (parent, key) in s.relationships.items():
            miss = f"{c} NOT IN (SELECT {key} FROM {names[parent]})"
            parts.append(
                f"{head}'{s.table}.{c}' AS check_name, 'relationships' AS check_type, CASE WHEN count(*) FILTER ({miss}) = 0 "
                f"THEN 'pass' ELSE 'warn' END AS status, count({c}) AS rows_checked, count(*) FILTER ({miss}) AS rows_failed FROM {names[s.table]}"
            )
    return " UNION ALL ".join(parts)


add("dq_14_declared_checks", lambda d: _results(d).drop("details"), _declared_sql())


def _all_results(d: Data):
    return runner.union_results([_results(d), _gold(d), project.validate_features(_dirty(d), d.now)])


ALL_STATUS = f"""(SELECT status FROM ({_declared_sql()}) UNION ALL SELECT 'fail' UNION ALL SELECT unnest(['fail', 'warn', 'warn', 'warn']))"""
add(
    "dq_11_evaluate_gate", lambda d: runner.evaluate_gate(_all_results(d), d.now + F.expr("interval 30 minutes")),
    f"SELECT count(*) FILTER (status = 'fail') AS fail_count, count(*) FILTER (status = 'fail') = 0 AS gate_open FROM {ALL_STATUS}",
)
add(
    "dq_12_run_summary", lambda d: runner.run_summary(_all_results(d)),
    f"""SELECT count(*) FILTER (status = 'pass') AS pass_count, count(*) FILTER (status = 'warn') AS warn_count,
      count(*) FILTER (status = 'fail') AS fail_count, count(*) FILTER (status = 'skip') AS skip_count, count(*) AS total,
      CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 'fail' ELSE 'pass' END AS status FROM {ALL_STATUS}""",
)
add(
    "dq_13_source_freshness",
    lambda d: project.source_freshness(
        {"transactions": (d.tx, "created_at"), "repayments": (d.versions, "updated_at")},
        F.lit("2001-08-01 05:00:00").cast("timestamp_ntz"), 2, 6,
    ),
    """SELECT t AS table_name, newest, CASE WHEN date_diff('second', newest, TIMESTAMP '2001-08-01 05:00:00') / 3600.0 > 6
      THEN 'error' WHEN date_diff('second', newest, TIMESTAMP '2001-08-01 05:00:00') / 3600.0 > 2 THEN 'warn' ELSE 'pass' END AS status
      FROM (SELECT 'transactions' AS t, max(created_at) AS newest FROM transactions UNION ALL
      SELECT 'repayments', max(updated_at) FROM repayment_versions)""",
)


def _raw_tables(d: Data):
    raws = {
        "bronze.transactions": changes.transaction_events(d.tx), "bronze.users": changes.user_events(d.users),
        "bronze.merchants": changes.merchant_events(d.merchants), "bronze.repayments": changes.repayment_events(d.versions),
        "bronze.installments": changes.installment_events(d.schedules),
    }
    return {k: v.withColumn("_ingested_at", d.now) for k, v in raws.items()}


@query(
    "dq_15_column_contracts",
    """SELECT * FROM (SELECT 'bronze.transactions' AS table_name, count(*) AS row_count, 0 AS missing FROM transactions UNION ALL
      SELECT 'bronze.users', count(*), 0 FROM users UNION ALL SELECT 'bronze.merchants', count(*), 0 FROM merchants UNION ALL
      SELECT 'bronze.repayments', count(*), 0 FROM repayment_versions UNION ALL SELECT 'bronze.installments', count(*), 0 FROM installments)""",
)
def _column_contracts(d: Data):
    """Contract columns missing from the files of the raw tables, and their rows, from the footers."""
    raws = {name: d.stored(name, lambda df=df: df) for name, df in _raw_tables(d).items()}
    return stored.coverage(stored.files_of(raws), {name: K.RAW_COLUMNS[name] for name in raws})


@query(
    "dq_16_layer_contracts",
    """SELECT 'silver.merchants' AS table_name, 'merchant_id' AS column_name, count(*) AS rows_failed FROM merchants
      WHERE merchant_id % 10 = 3 HAVING count(*) > 0
      UNION ALL SELECT 'silver.users', 'email', count(*) FROM users WHERE user_id % 10 = 3 HAVING count(*) > 0""",
)
def _layer_contracts(d: Data):
    """All contracts over data with planted NULLs in two required columns."""
    tables = {
        "silver.transactions": d.tx, "silver.repayments": d.repay,
        "silver.users": d.users.withColumn("email", F.when(F.col("user_id") % 10 != 3, F.col("email"))),
        "silver.merchants": d.merchants.withColumn("merchant_id", F.when(F.col("merchant_id") % 10 != 3, F.col("merchant_id"))),
        "silver.installments": d.schedules, "feature_store.user_credit_features": d.features,
    }
    parts = [
        contracts.schema_contract(df, K.CONTRACTS[n]).select(F.lit(n).alias("table_name"), "column_name", "rows_failed")
        for n, df in tables.items()
    ]
    return runner.union_results(parts)


@query(
    "dq_17_schema_contract",
    """SELECT 'not_null' AS check, 'decision_latency_ms' AS column_name, 'no NULL' AS expected, 'NULL' AS found,
      count(*) AS rows_failed FROM transactions WHERE decision_latency_ms IS NULL
    UNION ALL SELECT 'column_exists', 'channel', 'present', 'missing', 0
    UNION ALL SELECT 'column_type', 'amount', 'decimal(10,2)', 'decimal(12,2)', 0""",
)
def _contract(d: Data):
    return contracts.schema_contract(d.tx, [
        ("transaction_id", "bigint", False), ("amount", "decimal(10,2)", False), ("channel", "string", True),
        ("decision_latency_ms", "int", False),
    ])


add(
    "dq_18_schema_drift",
    lambda d: contracts.schema_drift(
        d.tx.select(F.to_json(F.struct(*d.tx.columns, F.lit("x").alias("__op"))).alias("value")), "value",
        known=["transaction_id", "user_id", "amount", "status", "created_at"], ignored=["__op"],
    ),
    """SELECT field, n_records FROM (SELECT 'merchant_id' AS field, count(*) AS n_records FROM transactions UNION ALL
      SELECT 'currency', count(*) FROM transactions UNION ALL
      SELECT 'decision_latency_ms', count(decision_latency_ms) FROM transactions UNION ALL
      SELECT 'installment_count', count(*) FROM transactions)""",
)
add(
    "dq_19_version_consistency",
    lambda d: project.version_consistency(
        d.features.unionByName(d.features.where("user_id % 13 = 0").withColumn("feature_version", F.lit("v2")))
    ),
    "SELECT user_id, snapshot_ts, 2 AS version_count FROM features WHERE user_id % 13 = 0",
)
add(
    "dq_20_approved_above_limit", lambda d: project.approved_above_limit(d.tx, d.users),
    """SELECT transaction_id, user_id, amount::DOUBLE AS amount, credit_limit::DOUBLE AS credit_limit
      FROM transactions JOIN users USING (user_id) WHERE status = 'approved' AND amount::DOUBLE > credit_limit::DOUBLE * 2.0""",
)
add(
    "dq_21_merchant_completeness", lambda d: project.merchant_completeness(d.kpis, 200),
    "SELECT count(DISTINCT merchant_id) AS merchants FROM kpis HAVING count(DISTINCT merchant_id) < 200",
)


GAP_SQL = """SELECT date_diff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS missing_days FROM ({src})
  HAVING date_diff('day', min(d), max(d)) + 1 - count(DISTINCT d) > 0"""
add(
    "dq_22_risk_no_gaps", lambda d: missing_days(d.risk, "date"),
    GAP_SQL.format(src="SELECT date AS d FROM risk"),
)
add(
    "dq_22_matched_settlement_gaps", lambda d: missing_days(d.recon.where("status = 'matched'"), "settlement_date"),
    GAP_SQL.format(src="SELECT settlement_date AS d FROM recon WHERE status = 'matched'"),
)
add(
    "dq_23_settlement_variance", lambda d: project.settlement_variance(d.recon, 1.0).select("settlement_date", "merchant_id", "variance_pct"),
    "SELECT settlement_date, merchant_id, round(variance_pct, 6) AS variance_pct FROM recon WHERE abs(variance_pct) > 1.0",
)
add(
    "dq_24_cohort_repaid_not_zero", lambda d: project.cohort_repaid_not_zero(d.cohorts),
    "SELECT count(*) AS total, count(*) FILTER (total_repaid = 0) AS zero_rows FROM cohorts",
)
add(
    "dq_25_no_negative_amounts", lambda d: project.no_negative_amounts(d.raw("customer"), "c_acctbal").select("c_custkey", "c_acctbal"),
    "SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal FROM customer WHERE c_acctbal < 0",
)
add(
    "dq_26_rate_in_range", lambda d: project.rate_in_range(_dirty(d), "repayment_rate_90d").select("user_id"),
    "SELECT user_id FROM features WHERE user_id % 41 = 0",
)
add(
    "dq_27_layer_acceptance",
    lambda d: project.layer_acceptance([
        ("bronze.transactions", d.tx, 10000), ("silver.users", d.users, 1000), ("gold.user_cohorts", d.cohorts, 1000),
        ("feature_store.duplicate_keys", asof.latest_per_key(d.history, ["user_id", "valid_from"], "snapshot_ts"), 100),
    ]),
    """SELECT layer, n AS row_count, m AS minimum, n >= m AS passed FROM (SELECT 'bronze.transactions' AS layer, count(*) AS n, 10000 AS m
      FROM transactions UNION ALL SELECT 'silver.users', count(*), 1000 FROM users UNION ALL
      SELECT 'gold.user_cohorts', count(*), 1000 FROM cohorts UNION ALL
      SELECT 'feature_store.duplicate_keys', count(*), 100 FROM feature_history)""",
)
