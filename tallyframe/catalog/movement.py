"""Sources, sinks and streams: each query writes or streams whole tables and returns what landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe.catalog.base import AS_OF, EVENTS_AS_OF, Data, add, query
from tallyframe.catalog.changes import OP, TX_COLS
from tallyframe.catalog.features import feature_sql
from tallyframe.catalog.monitoring import audit
from tallyframe.catalog.relational import EXPOSURE_SQL, KPI_SQL
from tallyframe.checks import project, runner
from tallyframe.operators import cdc, incremental
from tallyframe.plans import marts, monitoring
from tallyframe.session import shared_path
from tallyframe.sources import changes, domain, tables
from tallyframe.streaming import jobs

T_AS_OF = f"TIMESTAMP '{AS_OF}'"
NTZ = "timestamp_ntz"


def _stream(d: Data, name: str):
    return changes.read_table_stream(d.spark, d.sf_dir, name)


# -- sources ------------------------------------------------------------------------------------------------


@query("src_01_cdc_stream", f"SELECT {TX_COLS} FROM transactions")
def _cdc_stream(d: Data):
    """Change events as JSON files, read as a stream, typed and landed."""
    path = shared_path(d.spark, "src01")
    sinks_in = f"{path}/in"
    changes.transaction_events(d.tx).write.json(sinks_in)
    stream = changes.read_cdc_stream(d.spark, "transactions", sinks_in)
    jobs.land_batches(cdc.type_transactions(stream), f"{path}/out")
    return jobs.landed(d.spark, f"{path}/out").drop("batch", "__op", "__source_ts_ms")


@query(
    "src_02_json_stream",
    """SELECT event_type, count(*) FILTER (event_id % 23 <> 0) AS good FROM app_events GROUP BY 1
      UNION ALL SELECT 'unreadable', count(*) FROM app_events WHERE event_id % 23 = 0""",
)
def _json_stream(d: Data):
    """JSON lines, one in twenty-three cut off; unreadable lines are counted, not lost."""
    path = shared_path(d.spark, "src02")
    line = F.to_json(F.struct(*changes.app_event_records(d.events).columns))
    records = changes.app_event_records(d.events).select(
        F.when(F.col("event_id").cast("bigint") % 23 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")
    )
    records.write.text(f"{path}/in")
    stream = changes.read_json_stream(d.spark, "app_events", f"{path}/in")
    jobs.land_batches(stream, f"{path}/out")
    rows = jobs.landed(d.spark, f"{path}/out")
    kind = F.when(F.col("_corrupt_record").isNotNull(), "unreadable").otherwise(F.col("event_type"))
    return rows.groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("good"))


add(
    "src_03_snapshot_then_changes",
    lambda d: cdc.initial_snapshot_then_changes(
        changes.transaction_events(d.tx).drop("__op", "__source_ts_ms"), changes.transaction_events(d.tx)
    ).groupBy(F.col("__op").alias("op")).agg(F.count(F.lit(1)).alias("n")),
    f"""SELECT 'r' AS op, count(*) AS n FROM transactions UNION ALL
      SELECT {OP.format(k='transaction_id')}, count(*) FROM transactions GROUP BY 1""",
)
add(
    "src_04_read_source_table",
    lambda d: tables.read_source_table(
        d.spark, f"{d.sf_dir}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"],
        "o_orderdate >= timestamp_ntz '2000-01-01 00:00:00'", ts_as_string=["o_orderdate"],
    ),
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, round(o_totalprice, 6) AS o_totalprice
      FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
)
add(
    "src_06_read_seed",
    lambda d: d.merchants.join(F.broadcast(d.seed), "merchant_category").groupBy("display_name", "risk_weight").agg(
        F.count(F.lit(1)).alias("merchants")
    ),
    "SELECT display_name, risk_weight, count(*) AS merchants FROM merchants JOIN category_seed USING (merchant_category) GROUP BY 1, 2",
)


@query("src_07_named_sources", "SELECT 'silver.orders' AS source, count(*) AS n, 6 AS error_hours FROM orders")
def _sources(d: Data):
    catalog = tables.SourceCatalog(d.spark)
    catalog.register("silver", "orders", f"{d.sf_dir}/orders.parquet", loaded_at="o_orderdate", warn_hours=2, error_hours=6)
    hours = catalog.freshness("silver", "orders")["error_hours"]
    return catalog.source("silver", "orders").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("silver.orders").alias("source"), "n", F.lit(hours).alias("error_hours")
    )


add(
    "src_08_request_log",
    lambda d: tables.read_request_log(d.raw("events"), "ts", "value", "event_type").groupBy("route").agg(
        F.count(F.lit(1)).alias("requests"), F.max("latency_ms").alias("slowest")
    ),
    "SELECT route, count(*) AS requests, round(max(latency_ms), 6) AS slowest FROM request_log GROUP BY 1",
)


@query(
    "src_09_test_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in
                       ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                        "embeddings", "pages", "benchmark", "labels", "conversations")),
)
def _all_tables(d: Data):
    names = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
             "labels conversations").split()
    return runner.union_results([
        d.raw(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n in names
    ])


# -- sinks ---------------------------------------------------------------------------------------------------


@query("snk_01_append_raw", "SELECT strftime(created_at, '%Y%m')::INT AS month, count(*) AS n FROM transactions GROUP BY 1")
def _append_raw(d: Data):
    path = shared_path(d.spark, "snk01")
    sinks.append_raw(d.tx, path, at=d.now)
    return d.spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


UPSERT_COLS = "transaction_id, installment_number, amount::DOUBLE AS amount, updated_at"


@query("snk_02_upsert_latest", f"SELECT {UPSERT_COLS} FROM repayments")
def _upsert(d: Data):
    """Versions arrive in two batches, the newer half first; the newest version still wins."""
    path = shared_path(d.spark, "snk02")
    late = F.col("updated_at") >= F.lit("1998-06-01 00:00:00").cast(NTZ)
    for part in (d.versions.where(late), d.versions.where(~late)):
        sinks.upsert_latest(d.spark, part, path, domain.REPAYMENT_KEYS, domain.REPAYMENT_VERSION_ORDER, buckets=8)
    return d.spark.read.parquet(path).select("transaction_id", "installment_number", "amount", "updated_at")


@query("snk_03_delete_insert", KPI_SQL.format(src="kpis"))
def _delete_insert(d: Data):
    """A first load of older days with wrong numbers, then the slice and the rest; equals a full build."""
    path = shared_path(d.spark, "snk03")
    monthly = d.kpis.withColumn("month", F.date_format("date", "yyyyMM"))
    wrong = monthly.where("date < date'1999-01-01' and merchant_id % 2 = 0").withColumn("declined_count", F.lit(-1).cast("bigint"))
    for part in (wrong, monthly):
        sinks.delete_insert(d.spark, part, path, ["merchant_id", "date"], ["month"])
    return d.spark.read.parquet(path).drop("month")


@query("snk_04_merge_features", feature_sql("feature_history"))
def _merge(d: Data):
    path, rows = shared_path(d.spark, "snk04"), d.history
    stale = rows.where("user_id % 3 = 0").withColumn("tx_velocity_7d", F.lit(-1))
    for part in (stale, rows):
        sinks.merge_features(d.spark, part, path)
    return d.spark.read.parquet(path).drop("valid_day")


@query("snk_05_append_serving", "SELECT user_id, count(*) * 2 AS n FROM feature_history GROUP BY 1")
def _serving(d: Data):
    path = shared_path(d.spark, "snk05")
    for _ in range(2):
        sinks.append_serving(d.history, path)
    return d.spark.read.parquet(path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("snk_06_distributed_write", "SELECT user_id, tx_velocity_30d FROM features")
def _write(d: Data):
    path = shared_path(d.spark, "snk06")
    sinks.write_rows(d.features, path)
    return d.spark.read.parquet(path).select("user_id", "tx_velocity_30d")


@query("snk_07_export_csv", "SELECT user_id, days_since_first_tx, 'v1' AS version FROM features")
def _csv(d: Data):
    folder = shared_path(d.spark, "snk07")
    sinks.export_csv_audit(d.features, folder, "v1", "20010801")
    schema = "user_id bigint, snapshot_ts string, valid_from string, valid_to string, feature_version string, " + ", ".join(
        f"{c} {d.features.schema[c].dataType.simpleString()}" for c in d.features.columns[5:]
    )
    return d.spark.read.schema(schema).option("header", True).csv(f"{folder}/version=v1/snapshot=20010801").select(
        "user_id", "days_since_first_tx", F.col("feature_version").alias("version")
    )


@query(
    "snk_08_append_results",
    f"""SELECT check_name, status, rows_checked FROM (SELECT 'completeness_check' AS check_name, CASE WHEN f.n / u.n >= 0.95 THEN 'pass'
      WHEN f.n / u.n >= 0.80 THEN 'warn' ELSE 'fail' END AS status, u.n AS rows_checked FROM (SELECT count(*) AS n FROM users) u,
      (SELECT count(DISTINCT user_id) AS n FROM features) f UNION ALL SELECT 'null_check', 'pass', count(*) FROM features)""",
)
def _append_results(d: Data):
    path = shared_path(d.spark, "snk08")
    for row in (project.feature_completeness(d.users, d.features, d.now), project.feature_nulls(d.features, d.now)):
        sinks.append_results(row, path)
    return d.spark.read.parquet(path).select("check_name", "status", "rows_checked")


@query(
    "snk_09_append_audit_event",
    "SELECT event_type AS dag_id, count(*) AS n, min('{\"user_id\":' || user_id || '}') AS first_details FROM app_events GROUP BY 1",
)
def _append_audit(d: Data):
    path = shared_path(d.spark, "snk09")
    sinks.append_audit_event(audit(d), path)
    return d.spark.read.parquet(path).groupBy("dag_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("details").alias("first_details")
    )


@query(
    "snk_10_dead_letters",
    "SELECT CASE WHEN event_id % 23 = 0 THEN 'dead' ELSE 'good' END AS kind, count(*) AS n FROM app_events GROUP BY 1",
)
def _dead_letters(d: Data):
    path = shared_path(d.spark, "snk10")
    records = changes.app_event_records(d.events)
    line = F.to_json(F.struct(*records.columns))
    records.select(
        F.when(F.col("event_id").cast("bigint") % 23 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")
    ).write.text(f"{path}/in")
    stream = changes.read_json_stream(d.spark, "app_events", f"{path}/in")
    jobs.land(stream, jobs.split_dead_letters(path, "app_events"), f"{path}/_checkpoint")
    parts = [
        d.spark.read.parquet(f"{path}/{k}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
        for k in ("good", "dead")
    ]
    return runner.union_results(parts)


@query(
    "snk_11_backfill",
    """SELECT 'transactions' AS table_name, count(*) AS n FROM transactions WHERE transaction_id % 10 <> 0
      UNION ALL SELECT 'repayments', count(*) FROM repayment_versions WHERE op <> 'd'
      UNION ALL SELECT 'users', count(*) FROM users WHERE user_id % 10 <> 0
      UNION ALL SELECT 'merchants', count(*) FROM merchants WHERE merchant_id % 10 <> 0
      UNION ALL SELECT 'installments', count(*) FROM installments WHERE schedule_id % 10 <> 0
      UNION ALL SELECT 'app_events', count(*) FROM app_events WHERE event_id % 13 <> 0
      UNION ALL SELECT 'merchant_sessions', count(*) FROM app_events""",
)
def _backfill(d: Data):
    raw = {
        "transactions": changes.transaction_events(d.tx), "repayments": changes.repayment_events(d.versions),
        "users": changes.user_events(d.users), "merchants": changes.merchant_events(d.merchants),
        "installments": changes.installment_events(d.schedules), "app_events": changes.app_event_records(d.events),
        "merchant_sessions": changes.merchant_session_records(d.events),
    }
    silver = {
        "transactions": cdc.silver_transactions, "repayments": cdc.silver_repayments, "users": cdc.silver_users,
        "merchants": cdc.silver_merchants, "installments": cdc.silver_installments,
        "app_events": cdc.silver_app_events, "merchant_sessions": cdc.silver_merchant_sessions,
    }
    jobs_by_table = {t: (lambda df, t=t: silver[t](jobs.TYPERS[t](df))) for t in silver}
    paths = sinks.backfill(raw, jobs_by_table, shared_path(d.spark, "snk11"))
    return runner.union_results([
        d.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        for t, p in paths.items()
    ])


add(
    "snk_12_retention", lambda d: sinks.apply_retention(d.tx, "created_at", "2 years", d.now).select("transaction_id"),
    f"SELECT transaction_id FROM transactions WHERE created_at >= {T_AS_OF} - INTERVAL 2 YEAR",
)


@query(
    "snk_13_compact_audit",
    f"SELECT event_type AS dag_id, count(*) AS n FROM app_events WHERE created_at >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY GROUP BY 1",
)
def _compact(d: Data):
    path = shared_path(d.spark, "snk13")
    sinks.append_audit_event(audit(d), f"{path}/log")
    sinks.compact_audit(d.spark, f"{path}/log", f"{path}/compact", "event_time", d.events_now)
    return d.spark.read.parquet(f"{path}/compact").groupBy("dag_id").agg(F.count(F.lit(1)).alias("n"))


# -- streams ----------------------------------------------------------------------------------------------------


@query(
    "str_01_raw_ingest",
    "SELECT strftime(created_at, '%Y%m')::INT AS month, count(*) AS n, sum(amount)::DOUBLE AS amount FROM transactions GROUP BY 1",
)
def _raw_ingest(d: Data):
    """The orders table streamed as change events, typed and appended by month."""
    path = shared_path(d.spark, "str01")
    events = changes.transaction_events(domain.project(_stream(d, "orders"), domain.TRANSACTIONS))
    jobs.write_raw(jobs.raw_ingest(events, "transactions"), f"{path}/raw", f"{path}/_checkpoint").awaitTermination()
    return d.spark.read.parquet(f"{path}/raw").groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


@query(
    "str_02_silver_fanout",
    """SELECT 'silver' AS kind, count(*) AS n FROM transactions WHERE transaction_id % 10 <> 0
      UNION ALL SELECT 'delete_audit', count(*) FROM transactions WHERE transaction_id % 10 = 0
      UNION ALL SELECT 'update_audit', count(*) FROM transactions WHERE transaction_id % 10 BETWEEN 1 AND 2
      UNION ALL SELECT 'exposure', count(DISTINCT user_id) FROM transactions WHERE status = 'approved'""",
)
def _fanout(d: Data):
    path = shared_path(d.spark, "str02")
    events = changes.transaction_events(domain.project(_stream(d, "orders"), domain.TRANSACTIONS))
    jobs.land(cdc.type_transactions(events), jobs.silver_fanout(path), f"{path}/_checkpoint")

    def rows(kind: str):
        out = d.spark.read.parquet(f"{path}/{kind}")
        out = marts.merge_exposure(out) if kind == "exposure" else out
        return out.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")

    return runner.union_results([rows(k) for k in ("silver", "delete_audit", "update_audit", "exposure")])


@query("str_03_streaming_exposure", EXPOSURE_SQL)
def _exposure(d: Data):
    path = shared_path(d.spark, "str03")
    stream = domain.project(_stream(d, "orders"), domain.TRANSACTIONS)
    jobs.land_batches(jobs.streaming_exposure(stream), path, "update")
    return jobs.settled(d.spark, path, ["user_id"])


@query("str_04_dedup_replays", "SELECT count(*) AS n, count(DISTINCT transaction_id) AS keys FROM transactions")
def _dedup(d: Data):
    """Every order delivered twice; each lands once."""
    path = shared_path(d.spark, "str04")
    events = changes.transaction_events(domain.project(_stream(d, "orders"), domain.TRANSACTIONS))
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy").withColumn(
        "event_time", F.timestamp_millis("__source_ts_ms")
    )
    jobs.land_batches(jobs.dedup_replays(twice, ["transaction_id", "__source_ts_ms"], "event_time"), path)
    return jobs.landed(d.spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("transaction_id").alias("keys")
    )


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


NEWEST_LINE = """SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1"""


def _fed(d: Data, path: str, slices: list, read, run) -> None:
    """Write one slice after the other to a folder; after each the stream takes what is new."""
    for part in slices:
        part.write.mode("append").parquet(f"{path}/in")
        run(read(part.schema))


def _line_state(d: Data, label: str):
    """Lines in three slices that have nothing to do with their order; the second and later runs go on from the stored state."""
    path = shared_path(d.spark, label)
    lines = d.raw("lineitem").select(*LINE_KEYS, *LINE_ORDER, "l_returnflag")
    _fed(
        d, path, [lines.where(F.col("l_partkey") % 3 == i) for i in (2, 0, 1)],
        lambda schema: d.spark.readStream.schema(schema).parquet(f"{path}/in"),
        lambda stream: jobs.land_state(jobs.keyed_state(stream, LINE_KEYS, LINE_ORDER), path),
    )
    return path


@query("str_05_latest_state", f"SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM ({NEWEST_LINE})")
def _latest(d: Data):
    path = _line_state(d, "str05")
    jobs.fold_state(d.spark, path, LINE_KEYS, LINE_ORDER)
    return jobs.current_state(d.spark, path, LINE_KEYS, LINE_ORDER).select(*LINE_KEYS, "l_shipdate", "l_partkey")


@query(
    "str_05_latest_state_deletes",
    f"SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM ({NEWEST_LINE}) WHERE l_returnflag <> 'R'",
)
def _latest_deletes(d: Data):
    """Returned lines count as deletes: a key whose newest row is one is gone, an older delete changes nothing."""
    path = _line_state(d, "str05-deletes")
    return jobs.current_state(d.spark, path, LINE_KEYS, LINE_ORDER, F.col("l_returnflag") == "R").select(*LINE_KEYS, "l_shipdate", "l_partkey")


@query("str_05_changed_keys", "SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS keys, true AS one_row_per_key FROM lineitem WHERE l_partkey % 3 = 1")
def _changed_keys(d: Data):
    """The last batch puts out the keys it has and no others."""
    rows = jobs.landed(d.spark, _line_state(d, "str05-changed"))
    last = rows.where(F.col("batch") == rows.agg(F.max("batch").alias("m")).scalar())
    return last.agg(F.count_distinct(*LINE_KEYS).alias("keys"), (F.count(F.lit(1)) == F.count_distinct(*LINE_KEYS)).alias("one_row_per_key"))


def _windowed(d: Data, label: str, build):
    path = shared_path(d.spark, label)
    jobs.land_batches(build(domain.project(_stream(d, "events"), domain.APP_EVENTS)), path, "update")
    return jobs.settled(d.spark, path, ["window_start", "window_end"])


add(
    "str_06_ingest_rate", lambda d: _windowed(d, "str06", lambda s: jobs.ingest_rate(s, "created_at")),
    """SELECT time_bucket(INTERVAL 5 MINUTE, created_at) AS window_start, time_bucket(INTERVAL 5 MINUTE, created_at) + INTERVAL 5 MINUTE
      AS window_end, count(*) AS rows_in FROM app_events GROUP BY 1, 2""",
)


@query(
    "str_07_approval_rate_sliding",
    """SELECT w AS window_start, w + INTERVAL 24 HOUR AS window_end, count(*) AS total, count(*) FILTER (status = 'approved') AS approved
      FROM (SELECT status, unnest(generate_series(date_trunc('hour', created_at)::TIMESTAMP - INTERVAL 23 HOUR,
        date_trunc('hour', created_at)::TIMESTAMP, INTERVAL 1 HOUR)) AS w FROM transactions) GROUP BY 1, 2""",
)
def _sliding(d: Data):
    path = shared_path(d.spark, "str07")
    stream = domain.project(_stream(d, "orders"), domain.TRANSACTIONS)
    jobs.land_batches(jobs.approval_rate_sliding(stream, "created_at"), path, "update")
    return jobs.settled(d.spark, path, ["window_start", "window_end"])


add(
    "str_08_minute_rates",
    lambda d: _windowed(d, "str08", lambda s: jobs.minute_rates(s, "created_at", "value")).drop("p99"),
    """SELECT date_trunc('minute', created_at)::TIMESTAMP AS window_start, date_trunc('minute', created_at)::TIMESTAMP + INTERVAL 1 MINUTE
      AS window_end, count(*) AS requests FROM app_events GROUP BY 1, 2""",
)
SESSION_SQL = """SELECT user_id, min(created_at) AS first_event, max(created_at) AS last_event, count(*) AS events,
      floor(epoch(max(created_at)))::BIGINT - floor(epoch(min(created_at)))::BIGINT AS duration_seconds FROM (
      SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY created_at ROWS UNBOUNDED PRECEDING) AS s FROM (
        SELECT *, CASE WHEN created_at > lag(created_at) OVER (PARTITION BY user_id ORDER BY created_at) + INTERVAL 6 HOUR
          THEN 1 ELSE 0 END AS brk FROM app_events)) GROUP BY user_id, s"""


@query("str_09_sessionize", SESSION_SQL)
def _sessions(d: Data):
    """Events as four slices of days, landed with a ledger of late rows, then cut into sessions by event time; equals the batch."""
    path, day = shared_path(d.spark, "str09"), F.dayofmonth("created_at")
    rows = d.events.select("event_id", "user_id", F.col("created_at").cast("timestamp").alias("created_at"))
    gap, delay = "6 hours", "1 hour"
    _fed(
        d, path, [rows.where(day.between(lo, lo + 7)) for lo in (1, 9, 17, 25)],
        lambda schema: d.spark.readStream.schema(schema).parquet(f"{path}/in"),
        lambda stream: (
            jobs.land_timely(stream, path, "created_at", d.events_now, delay),
            jobs.land_sessions(d.spark, path, rows.schema, "created_at", gap=gap, delay=delay),
        ),
    )
    jobs.close_sessions(d.spark, path, rows.schema, "created_at", gap, delay)
    jobs.land_sessions(d.spark, path, rows.schema, "created_at", gap=gap, delay=delay)
    return jobs.landed(d.spark, f"{path}/sessions").drop("batch")


add("str_09_sessionize_batch", lambda d: jobs.sessionize(d.events, "created_at", gap="6 hours"), SESSION_SQL)


@query(
    "str_09_sessions_by_id",
    """SELECT user_id || '-' || strftime(created_at, '%Y%m%d') AS session_id, date_trunc('millisecond', min(created_at)) AS first_event,
      date_trunc('millisecond', max(created_at)) AS last_event, count(*) AS events,
      floor(epoch(max(created_at)))::BIGINT - floor(epoch(min(created_at)))::BIGINT AS duration_seconds
      FROM app_events WHERE event_id % 13 <> 0 GROUP BY 1""",
)
def _sessions_by_id(d: Data):
    typed = cdc.silver_app_events(cdc.type_app_events(changes.app_event_records(d.events)))
    return jobs.sessionize(typed, "created_at", session_id="session_id")


LATE_SQL = """WITH e AS (SELECT event_id, date_trunc('millisecond', created_at) AS ts, event_id % 13 = 0 AS bad,
    event_id % 17 = 0 AND day(created_at) <= 20 AS held_back, day(created_at) <= 20 AS early FROM app_events),
  mark AS (SELECT max(ts) FILTER (early AND NOT held_back AND NOT bad) - INTERVAL 1 HOUR AS m FROM e),
  k AS (SELECT e.*, CASE WHEN bad THEN 'bad date' WHEN held_back AND ts < m THEN 'behind the watermark' ELSE 'landed' END AS kind FROM e, mark)"""


def _late_events(d: Data):
    """Events in three slices of days. One in 13 has a zero or far-future date, one in 17 is held back until the last slice."""
    path, day = shared_path(d.spark, "str10"), F.dayofmonth("created_at")
    held = (F.col("event_id") % 17 == 0) & (day <= 20)
    slices = [d.events.where((day <= 10) & ~held), d.events.where(day.between(11, 20) & ~held), d.events.where((day > 20) | held)]
    for part in slices:
        changes.app_event_records(part).write.mode("append").json(f"{path}/in")
        stream = cdc.type_app_events(changes.read_json_stream(d.spark, "app_events", f"{path}/in").drop("_corrupt_record"))
        jobs.land_timely(stream, path, "created_at", d.events_now, "1 hour")
    return path


@query("str_10_guard_dates", f"{LATE_SQL} SELECT kind, count(*) AS n FROM k GROUP BY 1")
def _guard(d: Data):
    """What landed and what became a dead letter, counted over the rows themselves."""
    rows = d.spark.read.parquet(f"{_late_events(d)}/rows")
    return rows.groupBy(F.coalesce("reason", F.lit("landed")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "str_10_late_ledger",
    f"""{LATE_SQL} SELECT 2 - (CASE WHEN held_back THEN 0 WHEN early AND day(ts) <= 10 THEN 2 WHEN early THEN 1 ELSE 0 END) AS batch,
      count(*) AS rows_in, count(*) FILTER (kind = 'landed') AS landed, count(*) FILTER (kind = 'bad date') AS bad,
      count(*) FILTER (kind = 'behind the watermark') AS late, true AS accounted FROM k GROUP BY 1""",
)
def _late_ledger(d: Data):
    """The ledger of every batch: rows in are the rows landed and the dead letters."""
    whole = F.col("rows_in") == F.col("landed") + F.col("bad") + F.col("late")
    return jobs.ledger(d.spark, _late_events(d)).select(F.col("batch").cast("int").alias("batch"), "rows_in", "landed", "bad", "late", whole.alias("accounted"))


def _observed(d: Data, stream, label: str, ts: str):
    """Metrics rows of a landed stream, one per batch, from the pass that wrote it."""
    path = shared_path(d.spark, label)
    jobs.land(stream, jobs.observed_batches(path, ts), f"{path}/_checkpoint")
    return d.spark.read.parquet(f"{path}/metrics")


@query(
    "str_11_ingest_lag",
    f"SELECT date_diff('minute', max(created_at), TIMESTAMP '{EVENTS_AS_OF}') AS lag_minutes FROM app_events",
)
def _ingest_lag(d: Data):
    stream = domain.project(_stream(d, "events"), domain.APP_EVENTS)
    return monitoring.staleness(_observed(d, stream, "str11", "created_at"), "newest", d.events_now, "minute", "lag_minutes")


@query(
    "mon_09_ingest_lag_observed",
    """SELECT date_diff('minute', max(created_at), TIMESTAMP '2001-08-02 07:31:00') AS lag_minutes, count(*) AS rows,
      min(created_at) AS oldest FROM transactions""",
)
def _observed_lag(d: Data):
    """Lag, rows and oldest time of the orders stream from its metrics, without a scan of what it landed."""
    metrics = _observed(d, domain.project(_stream(d, "orders"), domain.TRANSACTIONS), "mon09", "created_at")
    now = F.lit("2001-08-02 07:31:00").cast(NTZ)
    return monitoring.staleness(metrics, "newest", now, "minute", "lag_minutes").withColumns({
        "rows": metrics.agg(F.sum("rows").alias("n")).scalar(), "oldest": metrics.agg(F.min("oldest").alias("o")).scalar(),
    })


@query("inc_01_incremental_equals_full", KPI_SQL.format(src="kpis"))
def _incremental_mart(d: Data):
    """A mart built up to an older day, then advanced by its recomputed slice; equals a full build."""
    path = shared_path(d.spark, "inc01")
    cut = F.to_date("created_at") <= F.lit("2001-07-01").cast("date")

    def build(tx):
        return marts.merchant_daily_kpis(tx, d.merchants).withColumn("month", F.date_format("date", "yyyyMM"))

    sinks.delete_insert(d.spark, build(d.stg_tx.where(cut)), path, ["merchant_id", "date"], ["month"])
    target = sinks.read_table(d.spark, path)
    part = incremental.incremental_slice(d.stg_tx, target, "created_at", "3 days", "date")
    sinks.delete_insert(d.spark, build(part), path, ["merchant_id", "date"], ["month"])
    return d.spark.read.parquet(path).drop("month")
