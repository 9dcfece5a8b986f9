"""Expression tables: each expression is a column of a grouped job over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.base import Data, add
from tallyframe.functions import calendar as C
from tallyframe.functions import scalars as S
from tallyframe.operators import calendar_tables, tables
from tallyframe.operators.latest import deduplicate
from tallyframe.operators.quantiles import exact_quantiles


def counted(name: str, frame, column, sql_column: str, sql_from: str) -> None:
    """Register ``count(*) by expression`` for a column and its SQL."""
    add(
        name,
        lambda d: frame(d).groupBy(column().alias("value")).agg(F.count(F.lit(1)).alias("n")),
        f"SELECT {sql_column} AS value, count(*) AS n FROM {sql_from} GROUP BY 1",
    )


def orders(d: Data):
    return d.tx.withColumn("d", F.to_date("created_at"))


def events(d: Data):
    return d.events.withColumn("d", F.to_date("created_at"))


ORDERS = "(SELECT *, created_at::DATE AS d FROM transactions)"
EVENTS = "(SELECT *, created_at::DATE AS d FROM app_events)"
NTZ = "timestamp_ntz"
day = lambda: F.col("d")
ts = lambda: F.col("created_at")

# -- calendar columns ----------------------------------------------------------------------------------

CALENDAR = [
    ("dt_07_convert_timezone", lambda: F.hour(C.convert_timezone(ts(), "Asia/Riyadh")),
     "hour(created_at + INTERVAL 3 HOUR)::INT", "events"),
    ("dt_08_date_part", lambda: C.date_part("quarter", day()).cast("int"), "quarter(d)::INT", "orders"),
    ("dt_09_day_name", lambda: C.day_name(day()), "strftime(d, '%a')", "orders"),
    ("dt_09_day_name_long", lambda: C.day_name(day(), short=False), "dayname(d)", "orders"),
    ("dt_10_day_of_month", lambda: F.dayofmonth(day()), "day(d)::INT", "orders"),
    ("dt_11_day_of_week_iso", lambda: C.day_of_week(day()), "isodow(d)::INT", "orders"),
    ("dt_11_day_of_week_sunday", lambda: C.day_of_week(day(), False), "dayofweek(d)::INT + 1", "orders"),
    ("dt_12_day_of_year", lambda: F.dayofyear(day()), "dayofyear(d)::INT", "orders"),
    ("dt_13_from_unixtimestamp",
     lambda: C.from_unixtimestamp(F.unix_seconds(ts().cast("timestamp"))).cast(NTZ),
     "date_trunc('second', created_at)", "events"),
    ("dt_13_from_unix_millis",
     lambda: C.from_unixtimestamp(F.unix_millis(ts().cast("timestamp")), "milliseconds").cast(NTZ),
     "date_trunc('millisecond', created_at)", "events"),
    ("dt_14_to_unixtimestamp", lambda: C.to_unixtimestamp(ts()), "floor(epoch(created_at))::BIGINT", "events"),
    ("dt_15_iso_week_start", lambda: C.iso_week_start(day()), "date_trunc('week', d)::DATE", "orders"),
    ("dt_16_iso_week_end", lambda: C.iso_week_end(day()), "date_trunc('week', d)::DATE + 6", "orders"),
    ("dt_17_iso_week_of_year", lambda: C.iso_week_of_year(day()), "weekofyear(d)::INT", "orders"),
    ("dt_18_week_start", lambda: C.week_start(day()), "d - dayofweek(d)::INT", "orders"),
    ("dt_19_week_end", lambda: C.week_end(day()), "d - dayofweek(d)::INT + 6", "orders"),
    ("dt_20_week_of_year", lambda: C.week_of_year(day()), "ceil(dayofyear(d) / 7.0)::INT", "orders"),
    ("dt_21_month_name", lambda: C.month_name(day()), "strftime(d, '%b')", "orders"),
    ("dt_21_month_name_long", lambda: C.month_name(day(), False), "monthname(d)", "orders"),
    ("dt_22_n_days_ago", lambda: C.n_days_ago(10, day()), "d - 10", "orders"),
    ("dt_23_n_days_away", lambda: C.n_days_away(10, day()), "d + 10", "orders"),
    ("dt_24_n_weeks_ago", lambda: C.n_weeks_ago(2, day()), "(date_trunc('week', d) - INTERVAL 14 DAY)::DATE", "orders"),
    ("dt_25_n_weeks_away", lambda: C.n_weeks_away(2, day()), "(date_trunc('week', d) + INTERVAL 14 DAY)::DATE", "orders"),
    ("dt_26_n_months_ago", lambda: C.n_months_ago(3, day()), "date_trunc('month', d - INTERVAL 3 MONTH)::DATE", "orders"),
    ("dt_27_n_months_away", lambda: C.n_months_away(3, day()), "date_trunc('month', d + INTERVAL 3 MONTH)::DATE", "orders"),
    ("dt_28_last_week", lambda: C.last_week(day()), "(date_trunc('week', d) - INTERVAL 7 DAY)::DATE", "orders"),
    ("dt_29_next_week", lambda: C.next_week(day()), "(date_trunc('week', d) + INTERVAL 7 DAY)::DATE", "orders"),
    ("dt_30_last_month", lambda: C.last_month(day()), "date_trunc('month', d - INTERVAL 1 MONTH)::DATE", "orders"),
    ("dt_31_next_month", lambda: C.next_month(day()), "date_trunc('month', d + INTERVAL 1 MONTH)::DATE", "orders"),
    ("dt_32_last_month_name", lambda: C.last_month_name(day()), "strftime(d - INTERVAL 1 MONTH, '%b')", "orders"),
    ("dt_33_next_month_name", lambda: C.next_month_name(day(), False), "monthname(d + INTERVAL 1 MONTH)", "orders"),
    ("dt_34_last_month_number", lambda: C.last_month_number(day()), "month(d - INTERVAL 1 MONTH)::INT", "orders"),
    ("dt_35_next_month_number", lambda: C.next_month_number(day()), "month(d + INTERVAL 1 MONTH)::INT", "orders"),
    ("dt_36_now", lambda: F.hour(C.now("Asia/Riyadh", ts())), "hour(created_at + INTERVAL 3 HOUR)::INT", "events"),
    ("dt_37_today", lambda: C.today("Asia/Riyadh", ts()), "(created_at + INTERVAL 3 HOUR)::DATE", "events"),
    ("dt_38_yesterday", lambda: C.yesterday(day()), "d - 1", "orders"),
    ("dt_39_tomorrow", lambda: C.tomorrow(day()), "d + 1", "orders"),
    ("dt_40_periods_since",
     lambda: C.periods_since(ts(), F.lit("2024-01-31 00:00:00").cast(NTZ), "hour").cast("bigint"),
     "date_diff('hour', created_at, TIMESTAMP '2024-01-31 00:00:00')", "events"),
    ("dt_40_months_since",
     lambda: C.periods_since(ts(), F.lit("2001-08-01 00:00:00").cast(NTZ), "month"),
     "date_diff('month', created_at, TIMESTAMP '2001-08-01 00:00:00')", "orders"),
    ("dt_41_round_timestamp", lambda: F.to_date(C.round_timestamp(ts())),
     "date_trunc('day', created_at + INTERVAL 12 HOUR)::DATE", "events"),
]
for _name, _col, _sql, _src in CALENDAR:
    counted(_name, orders if _src == "orders" else events, _col, _sql, ORDERS if _src == "orders" else EVENTS)

# -- conversion and text columns of the change-data jobs -------------------------------------------------

SCALARS = [
    ("fn_01_decimal_from_text", lambda: F.col("amount").cast("string"),
     lambda: F.floor(S.decimal_of(F.col("v"), 4) / 1000).cast("bigint"), "floor(amount / 1000)::BIGINT", "orders"),
    ("fn_02_epoch_to_time", lambda: F.unix_micros(ts().cast("timestamp")),
     lambda: S.millis_to_ts((F.col("v") / 1000).cast("bigint")).cast(NTZ), "date_trunc('millisecond', created_at)", "events"),
    ("fn_03_millisecond_time", lambda: ts(), lambda: S.millis(F.col("v")).cast(NTZ),
     "date_trunc('millisecond', created_at)", "events"),
    ("fn_04_best_effort_time",
     lambda: F.when(F.col("event_id") % 2 == 0, F.date_format(ts(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
     .when(F.col("event_id") % 3 == 0, F.date_format(ts(), "dd/MM/yyyy HH:mm:ss"))
     .otherwise(F.date_format(ts(), "yyyy-MM-dd HH:mm:ss")),
     lambda: S.best_effort_ts(F.col("v")).cast(NTZ), "date_trunc('second', created_at)", "events"),
    ("fn_05_to_date", lambda: ts(), lambda: F.to_date("v"), "created_at::DATE", "events"),
    ("fn_06_int_or_zero", lambda: F.when(F.col("user_id") % 5 == 0, "n/a").otherwise(F.col("user_id").cast("string")),
     lambda: S.int_or_zero(F.col("v")), "CASE WHEN user_id % 5 = 0 THEN 0 ELSE user_id END", "events"),
    ("fn_07_year_month", lambda: ts(), lambda: S.year_month(F.col("v")), "strftime(created_at, '%Y%m')", "orders"),
    ("fn_08_month", lambda: ts(), lambda: F.month("v"), "month(created_at)::INT", "orders"),
    ("fn_09_start_of_hour", lambda: ts(), lambda: F.date_trunc("hour", "v").cast(NTZ), "date_trunc('hour', created_at)", "events"),
    ("fn_10_date_diff_minutes", lambda: ts(),
     lambda: C.date_diff("minute", F.date_trunc("day", "v").cast(NTZ), F.col("v")).cast("bigint"),
     "date_diff('minute', date_trunc('day', created_at)::TIMESTAMP, created_at)", "events"),
    ("fn_11_now_as_of", lambda: ts(),
     lambda: F.col("v") >= F.lit("2024-01-31 00:00:00").cast(NTZ) - F.expr("interval 7 days"),
     "created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY", "events"),
    ("fn_12_interval_arithmetic", lambda: ts(), lambda: F.to_date(F.col("v") + F.expr("interval 3 months")),
     "(created_at + INTERVAL 3 MONTH)::DATE", "orders"),
    ("fn_13_conditional", lambda: F.col("decision_latency_ms"),
     lambda: F.when(F.col("v").isNull(), "unknown").when(F.col("v") < 200, "fast").otherwise("slow"),
     "CASE WHEN decision_latency_ms IS NULL THEN 'unknown' WHEN decision_latency_ms < 200 THEN 'fast' ELSE 'slow' END", "orders"),
    ("fn_14_arithmetic", lambda: F.col("amount").cast("double"), lambda: F.abs(F.round(F.col("v") / 10000, 0) - 10).cast("int"),
     "abs(round(amount::DOUBLE / 10000, 0) - 10)::INT", "orders"),
    ("fn_15_text", lambda: F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")),
     lambda: F.when(F.trim("v").like("%C%"), F.lower(F.substring(F.trim("v"), 1, 3))).otherwise(F.length(F.trim("v")).cast("string")),
     "CASE WHEN upper(event_type) LIKE '%C%' THEN left(event_type, 3) ELSE length(event_type)::VARCHAR END", "events"),
    ("fn_16_hashes", lambda: F.col("user_id"), lambda: F.concat(S.mask_pii(F.col("v")), F.md5(F.col("v").cast("string").cast("binary"))),
     "upper(sha256(user_id::VARCHAR)) || md5(user_id::VARCHAR)", "events"),
    ("fn_17_casts", lambda: F.col("value"), lambda: F.col("v").cast("int").cast("string"), "trunc(value)::INT::VARCHAR", "events"),
    ("fn_19_json_details", lambda: F.col("event_type"), lambda: F.to_json(F.struct(F.col("v").alias("type"))),
     "'{\"type\":\"' || event_type || '\"}'", "events"),
    ("fn_20_regexp", lambda: F.col("event_data"), lambda: F.regexp_extract("v", r"(\d+)", 1),
     r"regexp_extract(event_data, '(\d+)', 1)", "events"),
    ("fn_21_epoch_days", lambda: F.unix_date("d"), lambda: S.epoch_days_to_date(F.col("v")), "d", "orders"),
]
for _name, _in, _col, _sql, _src in SCALARS:
    _frame = orders if _src == "orders" else events
    counted(
        _name, lambda d, f=_frame, i=_in: f(d).withColumn("v", i()), _col, _sql, ORDERS if _src == "orders" else EVENTS
    )

# -- expression helpers -----------------------------------------------------------------------------------

DOCS = "documents"
EXPRESSIONS = [
    ("eu_03_log_natural", lambda d: d.raw("documents"), lambda: F.floor(F.ln(F.col("n_chars"))).cast("int"),
     "floor(ln(n_chars))::INT", DOCS),
    ("eu_05_regexp_instr", lambda d: d.raw("documents"), lambda: S.regexp_position(F.col("text"), "[0-9]+"),
     "coalesce(length(regexp_extract(text, '^([^0-9]*)[0-9]', 1)) + CASE WHEN regexp_matches(text, '[0-9]') THEN 1 ELSE 0 END, 0)::INT", DOCS),
    ("eu_05_regexp_instr_later", lambda d: d.raw("documents"),
     lambda: S.regexp_position(F.col("text"), "(t)(h)", position=3, occurrence=4, flags="i"),
     "CASE WHEN len(string_split(lower(substr(text, 3)), 'th')) > 4 THEN list_sum(list_transform(string_split("
     "lower(substr(text, 3)), 'th')[1:4], lambda x: length(x)))::INT + 3 * 2 + 3 ELSE 0 END", DOCS),
    ("eu_06_md5", lambda d: d.raw("documents"), lambda: F.md5(F.col("text").cast("binary")), "md5(text)", DOCS),
]
for _name, _frame, _col, _sql, _src in EXPRESSIONS:
    counted(_name, _frame, _col, _sql, _src)

add(
    "eu_01_percentile_cont",
    lambda d: exact_quantiles(d.raw("events"), "value", {"q90": 0.9}, ["event_type"]),
    "SELECT event_type, round(quantile_cont(value, 0.9), 6) AS q90 FROM events GROUP BY 1",
)
add(
    "eu_02_median",
    lambda d: exact_quantiles(d.raw("events"), "value", {"median": 0.5}, ["user_id"]),
    "SELECT user_id, round(median(value), 6) AS median FROM events GROUP BY 1",
)
# random numbers have no SQL twin: the check is that all rows get one inside [0, 1)
add(
    "eu_04_rand",
    lambda d: d.raw("events").select(F.rand(42).alias("r")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("r") >= 0) & (F.col("r") < 1)).alias("inside")
    ),
    "SELECT count(*) AS n, count(*) AS inside FROM events",
)

# -- table utilities -------------------------------------------------------------------------------------------

add(
    "tu_01_deduplicate",
    lambda d: deduplicate(d.versions, ["transaction_id", "installment_number"], [
        F.desc("updated_at"), F.desc("tie_part"), F.desc("tie_supp"), F.desc("amount"), F.desc("tie_qty"),
    ]).select("transaction_id", "installment_number", "amount", "paid_at"),
    "SELECT transaction_id, installment_number, amount::DOUBLE AS amount, paid_at FROM repayments",
)
add(
    "tu_02_union_relations",
    lambda d: tables.union_relations(
        {"users": d.users, "merchants": d.merchants}, include=["user_id", "merchant_id", "credit_limit"],
        column_override={"credit_limit": "decimal(18,2)"},
    ),
    """SELECT 'users' AS source_name, user_id, credit_limit::DOUBLE AS credit_limit, NULL::INT AS merchant_id FROM users
      UNION ALL SELECT 'merchants', NULL, credit_limit::DOUBLE, merchant_id FROM merchants""",
)
add(
    "tu_03_pivot_compared",
    lambda d: tables.pivot(d.tx, ["status"], "installment_count", [1, 3, 6], prefix="from_", cmp=">="),
    """SELECT status, count(*) FILTER (installment_count >= 1) AS from_1, count(*) FILTER (installment_count >= 3) AS from_3,
      count(*) FILTER (installment_count >= 6) AS from_6 FROM transactions GROUP BY 1""",
)
add(
    "tu_03_pivot",
    lambda d: tables.pivot(
        d.tx, ["merchant_id"], "status", ["approved", "declined", "pending", "cancelled"], prefix="n_"
    ),
    """SELECT merchant_id, count(*) FILTER (status = 'approved') AS n_approved, count(*) FILTER (status = 'declined') AS n_declined,
      count(*) FILTER (status = 'pending') AS n_pending, count(*) FILTER (status = 'cancelled') AS n_cancelled
      FROM transactions GROUP BY 1""",
)
add(
    "tu_04_unpivot",
    lambda d: tables.unpivot(d.users.withColumn("is_vip", F.col("credit_tier") == "vip"), ["user_id"],
                             ["credit_tier", "kyc_status", "is_vip"]),
    """SELECT user_id, 'credit_tier' AS field_name, credit_tier AS value FROM users
      UNION ALL SELECT user_id, 'kyc_status', kyc_status FROM users
      UNION ALL SELECT user_id, 'is_vip', (credit_tier = 'vip')::VARCHAR FROM users""",
)
add(
    "tu_05_column_values",
    lambda d: tables.column_values(d.raw("documents"), "source", max_records=10, where="lang = 'en'"),
    "SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY 1 ORDER BY n DESC, source LIMIT 10",
)
add(
    "tu_06_surrogate_key",
    lambda d: d.tx.select("transaction_id", tables.surrogate_key(["transaction_id", "decision_latency_ms", "status"]).alias("sk")),
    f"""SELECT transaction_id, md5(transaction_id::VARCHAR || '-' ||
      coalesce(decision_latency_ms::VARCHAR, '{tables.NULL_KEY_MARKER}') || '-' || status) AS sk FROM transactions""",
)
EMPTIED = "CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang END"
add(
    "tu_07_nullcheck",
    lambda d: tables.nullcheck(d.raw("documents").select("doc_id", F.expr(EMPTIED).alias("lang"), "source")),
    f"SELECT doc_id, nullif({EMPTIED}, '') AS lang, nullif(source, '') AS source FROM documents",
)
add(
    "tu_08_nullcheck_cols",
    lambda d: d.raw("documents").select("doc_id", F.expr(EMPTIED).alias("lang")).select("doc_id", *tables.nullcheck_cols(["lang"])),
    f"SELECT doc_id, nullif({EMPTIED}, '') AS lang FROM documents",
)


def _order_bounds(d: Data):
    return d.tx.agg(F.to_date(F.min("created_at")).alias("lo"), F.to_date(F.max("created_at")).alias("hi"))


BOUNDS = "(SELECT min(created_at)::DATE AS lo, max(created_at)::DATE AS hi FROM transactions)"
DAYS = f"(SELECT unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY))::DATE AS date_day FROM {BOUNDS})"
add("tu_09_date_spine", lambda d: tables.date_spine(_order_bounds(d), "lo", "hi"), f"SELECT date_day FROM {DAYS}")
add(
    "dt_05_date_spine_months",
    lambda d: tables.date_spine(
        d.tx.agg(F.trunc(F.min("created_at"), "month").alias("lo"), F.to_date(F.max("created_at")).alias("hi")),
        "lo", "hi", "month", name="date_month",
    ),
    f"SELECT unnest(generate_series(date_trunc('month', lo), hi - 1, INTERVAL 1 MONTH))::DATE AS date_month FROM {BOUNDS}",
)


def _numbers(d: Data):
    """Every installment number up to the highest, with its rows; numbers come from a series."""
    top = d.versions.agg(F.max("installment_number").alias("top"))
    counts = d.versions.groupBy(F.col("installment_number").cast("bigint").alias("generated_number")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return tables.series_up_to(top, "top").join(counts, "generated_number", "left")


SERIES_SQL = """SELECT g AS generated_number, c.n FROM (SELECT unnest(generate_series(1, (SELECT max(l_linenumber)
  FROM lineitem)))::BIGINT AS g) LEFT JOIN (SELECT l_linenumber AS k, count(*) AS n FROM lineitem GROUP BY 1) c ON g = k"""
add("tu_10_generate_series", _numbers, SERIES_SQL)
add("dt_06_generate_series", _numbers, SERIES_SQL)
add(
    "tu_11_width_bucket",
    lambda d: d.tx.groupBy(tables.width_bucket(F.col("amount").cast("double"), 50000, 350000, 12).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    ),
    """SELECT CASE WHEN amount < 50000 THEN 0 WHEN amount >= 350000 THEN 13
      ELSE floor((amount::DOUBLE - 50000) / 25000)::BIGINT + 1 END AS bucket, count(*) AS n FROM transactions GROUP BY 1""",
)
_LAT, _LON = "(user_id % 170 - 85.0)", "(event_id % 360 - 180.0)"
add(
    "tu_12_haversine",
    lambda d: d.raw("events").select("event_id", *[
        F.round(tables.haversine(F.expr(_LAT).cast("double"), F.expr(_LON).cast("double"), F.lit(24.7), F.lit(46.7), u), 3).alias(u)
        for u in ("mi", "km")
    ]),
    "SELECT event_id, " + ", ".join(
        f"""round(2 * 3961 * asin(sqrt(power(sin(radians((24.7 - {_LAT}::DOUBLE) / 2)), 2) + cos(radians({_LAT}::DOUBLE)) *
        cos(radians(24.7)) * power(sin(radians((46.7 - {_LON}::DOUBLE) / 2)), 2))) * {f}, 3) AS {u}"""
        for u, f in (("mi", "1.0"), ("km", "1.60934"))
    ) + " FROM events",
)
add(
    "tu_13_safe_add",
    lambda d: d.tx.select("transaction_id", tables.safe_add(["decision_latency_ms", "installment_count"]).alias("total")),
    "SELECT transaction_id, coalesce(decision_latency_ms, 0) + coalesce(installment_count, 0) AS total FROM transactions",
)
add(
    "tu_14_safe_subtract",
    lambda d: d.tx.select("transaction_id", tables.safe_subtract(["decision_latency_ms", "installment_count"]).alias("rest")),
    "SELECT transaction_id, coalesce(decision_latency_ms, 0) - coalesce(installment_count, 0) AS rest FROM transactions",
)
add(
    "tu_15_safe_divide",
    lambda d: d.tx.select("transaction_id", tables.safe_divide(
        F.col("decision_latency_ms").cast("double"), F.col("merchant_id") % 5).alias("ratio")),
    "SELECT transaction_id, round(decision_latency_ms::DOUBLE / nullif(merchant_id % 5, 0), 6) AS ratio FROM transactions",
)
add(
    "tu_16_star",
    lambda d: tables.star(d.users, exclude=["full_name", "email", "credit_limit"], prefix="u_"),
    "SELECT user_id AS u_user_id, credit_tier AS u_credit_tier, kyc_status AS u_kyc_status FROM users",
)
add(
    "tu_17_filtered_columns",
    lambda d: d.merchants.select(*tables.filtered_columns(d.merchants, ["commission_rate", "CREDIT_LIMIT"])),
    "SELECT merchant_id, merchant_name, merchant_category, risk_tier, country FROM merchants",
)
add(
    "tu_18_single_value",
    lambda d: d.tx.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "share", F.round(F.col("n") / tables.single_value(d.tx, F.count(F.lit(1)), 0), 6)
    ),
    "SELECT status, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM transactions), 6) AS share FROM transactions GROUP BY 1",
)
HOST_SQL = "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)"
_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"
PATH_SQL = f"split_part(substr({_BARE}, coalesce(nullif(instr({_BARE}, '/'), 0), instr({_BARE}, '?') - 1) + 1), '?', 1)"
SOURCE_SQL = "nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '')"
for _name, _col, _sql in [
    ("tu_19_url_host", lambda: tables.url_host(F.col("url")), HOST_SQL),
    ("tu_20_url_path", lambda: tables.url_path(F.col("url")), PATH_SQL),
    ("tu_21_url_parameter", lambda: tables.url_parameter(F.col("url"), "utm_source"), SOURCE_SQL),
]:
    add(
        _name, lambda d, c=_col: d.raw("pages").select("page_id", c().alias("value")),
        f"SELECT page_id, {_sql} AS value FROM pages",
    )

# -- calendar tables ------------------------------------------------------------------------------------------------

add("dt_01_base_dates", lambda d: calendar_tables.base_dates(_order_bounds(d), "lo", "hi"), f"SELECT date_day FROM {DAYS}")
add(
    "dt_01_recent_base_dates",
    lambda d: calendar_tables.recent_base_dates(
        d.tx.agg(F.max("created_at").alias("as_of")), "as_of", 30
    ).select(F.to_date("date_day").alias("date_day")),
    """SELECT unnest(generate_series(m - 29, m, INTERVAL 1 DAY))::DATE AS date_day
      FROM (SELECT max(created_at)::DATE AS m FROM transactions)""",
)


def _dimension(d: Data):
    return calendar_tables.date_dimension(tables.date_spine(_order_bounds(d), "lo", "hi"))


def _sql_weeks(prefix: str, x: str) -> str:
    return (
        f"{x} - dayofweek({x})::INT AS {prefix}week_start_date, {x} - dayofweek({x})::INT + 6 AS {prefix}week_end_date, "
        f"ceil(dayofyear({x}) / 7.0)::INT AS {prefix}week_of_year, date_trunc('week', {x})::DATE AS {prefix}iso_week_start_date, "
        f"date_trunc('week', {x})::DATE + 6 AS {prefix}iso_week_end_date, weekofyear({x})::INT AS {prefix}iso_week_of_year"
    )


DIMENSION_SQL = f"""SELECT date_day, date_day - 1 AS prior_date_day, date_day + 1 AS next_date_day,
  (date_day - INTERVAL 1 YEAR)::DATE AS prior_year_date_day, date_day - 364 AS prior_year_over_year_date_day,
  dayofweek(date_day)::INT + 1 AS day_of_week, isodow(date_day)::INT AS day_of_week_iso, dayname(date_day) AS day_of_week_name,
  strftime(date_day, '%a') AS day_of_week_name_short, day(date_day)::INT AS day_of_month, dayofyear(date_day)::INT AS day_of_year,
  {_sql_weeks("", "date_day")}, {_sql_weeks("prior_year_", "(date_day - 364)")},
  month(date_day)::INT AS month_of_year, monthname(date_day) AS month_name, strftime(date_day, '%b') AS month_name_short,
  date_trunc('month', date_day)::DATE AS month_start_date, last_day(date_day) AS month_end_date,
  date_trunc('month', date_day - INTERVAL 1 YEAR)::DATE AS prior_year_month_start_date,
  last_day((date_day - INTERVAL 1 YEAR)::DATE) AS prior_year_month_end_date,
  quarter(date_day)::INT AS quarter_of_year, date_trunc('quarter', date_day)::DATE AS quarter_start_date,
  (date_trunc('quarter', date_day) + INTERVAL 3 MONTH)::DATE - 1 AS quarter_end_date, year(date_day)::INT AS year_number,
  date_trunc('year', date_day)::DATE AS year_start_date, (date_trunc('year', date_day) + INTERVAL 1 YEAR)::DATE - 1 AS year_end_date
  FROM {DAYS}"""
add("dt_02_date_dimension", _dimension, DIMENSION_SQL)
FISCAL_CTE = f"""WITH dim AS ({DIMENSION_SQL}),
  ye AS (SELECT DISTINCT year_number - 1 AS fy, month_end_date FROM dim WHERE month_of_year = 1),
  wk AS (SELECT year_number, month_of_year, date_day AS ws, date_day + 6 AS we FROM dim WHERE day_of_week = 1),
  cand AS (SELECT y.fy, w.we, rank() OVER (PARTITION BY y.fy ORDER BY abs(date_diff('day', w.we, y.month_end_date))) AS r
    FROM wk w JOIN ye y ON w.year_number - 1 = y.fy WHERE w.month_of_year = 1),
  yr AS (SELECT fy, lag(we) OVER (ORDER BY we) + 1 AS fs, we AS fe FROM cand WHERE r = 1),
  fd AS (SELECT d.date_day, y.fy AS fiscal_year_number, y.fs AS fiscal_year_start_date, y.fe AS fiscal_year_end_date,
    w.ws AS week_start_date, w.we AS week_end_date,
    dense_rank() OVER (PARTITION BY y.fy ORDER BY w.ws)::INT AS fiscal_week_of_year
    FROM dim d JOIN yr y ON d.date_day BETWEEN y.fs AND y.fe JOIN wk w ON d.date_day BETWEEN w.ws AND w.we)"""
add(
    "dt_03_fiscal_year_dates",
    lambda d: calendar_tables.fiscal_year_dates(_dimension(d), year_end_month=1),
    FISCAL_CTE + " SELECT * FROM fd",
)
PERIOD_SQL = FISCAL_CTE + """, p AS (SELECT *, least(floor((fiscal_week_of_year - 1) / 13.0), 3)::INT AS q,
    CASE WHEN fiscal_week_of_year = 53 THEN 3 WHEN (fiscal_week_of_year - 1) % 13 BETWEEN 0 AND 3 THEN 1
      WHEN (fiscal_week_of_year - 1) % 13 BETWEEN 4 AND 8 THEN 2 ELSE 3 END AS pq FROM fd)
  SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year, q * 3 + pq AS fiscal_period_number,
    q + 1 AS fiscal_quarter_number, pq AS fiscal_period_of_quarter,
    dense_rank() OVER (PARTITION BY q * 3 + pq ORDER BY fiscal_week_of_year)::INT AS fiscal_week_of_period FROM p"""
add("dt_04_fiscal_periods", lambda d: calendar_tables.fiscal_periods(_dimension(d), year_end_month=1), PERIOD_SQL)
