"""Generic table checks and expectations over the domain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.base import AS_OF, Data, add, query
from tallyframe.checks import expect, generic, stored
from tallyframe.operators import scd2
from tallyframe.operators.ordered import with_next

T_AS_OF = f"TIMESTAMP '{AS_OF}'"
ID = "transaction_id"


def ids(df):
    return df.select(ID)


# -- generic table checks --------------------------------------------------------------------------------

add(
    "gt_01_accepted_range", lambda d: ids(generic.accepted_range(d.tx, "decision_latency_ms", 100, 450)),
    f"SELECT {ID} FROM transactions WHERE NOT (decision_latency_ms >= 100) OR NOT (decision_latency_ms <= 450)",
)
add(
    "gt_01_accepted_range_strict", lambda d: ids(generic.accepted_range(d.tx, "decision_latency_ms", 100, 450, inclusive=False)),
    f"SELECT {ID} FROM transactions WHERE NOT (decision_latency_ms > 100) OR NOT (decision_latency_ms < 450)",
)
add(
    "gt_02_at_least_one", lambda d: generic.at_least_one(d.versions, "paid_at", ["status"]),
    "SELECT status, count(paid_at) AS filled FROM repayment_versions GROUP BY 1 HAVING count(paid_at) = 0",
)
add(
    "gt_03_cardinality_equality", lambda d: generic.cardinality_equality(d.tx, "user_id", d.events, "user_id"),
    """SELECT coalesce(a.k, b.k) AS value_field, coalesce(a.n, 0) AS count_a, coalesce(b.n, 0) AS count_b
      FROM (SELECT user_id AS k, count(*) AS n FROM transactions GROUP BY 1) a
      FULL JOIN (SELECT user_id AS k, count(*) AS n FROM app_events GROUP BY 1) b ON a.k = b.k
      WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
)
PAIRED = """(SELECT coalesce(a.m, b.m) AS merchant_id, coalesce(a.n, 0) AS count_a, coalesce(b.n, 0) AS count_b
  FROM (SELECT merchant_id AS m, count(*) AS n FROM transactions GROUP BY 1) a
  FULL JOIN (SELECT merchant_id AS m, count(*) AS n FROM stg_transactions GROUP BY 1) b ON a.m = b.m)"""
add(
    "gt_04_equal_rowcount", lambda d: generic.equal_rowcount(d.tx, d.stg_tx, ["merchant_id"]),
    f"SELECT *, abs(count_a - count_b) AS diff_count FROM {PAIRED} WHERE count_a <> count_b",
)
add(
    "gt_04_equal_rowcount_total", lambda d: generic.equal_rowcount(d.tx, d.stg_tx),
    """SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count FROM (SELECT (SELECT count(*) FROM transactions) AS a,
      (SELECT count(*) FROM stg_transactions) AS b) WHERE a <> b""",
)
EQ_SQL = """SELECT 'a_minus_b' AS which_diff, * FROM (SELECT {c} FROM {a} EXCEPT SELECT {c} FROM {b}) UNION ALL
  SELECT 'b_minus_a', * FROM (SELECT {c} FROM {b} EXCEPT SELECT {c} FROM {a})"""
add(
    "gt_05_equality", lambda d: generic.equality(d.tx, d.stg_tx, [ID, "status"]),
    EQ_SQL.format(c=f"{ID}, status", a="transactions", b="stg_transactions"),
)
add(
    "gt_05_equality_precision",
    lambda d: generic.equality(
        d.raw("events").select("event_id", "value"),
        d.raw("events").select("event_id", F.expr("value + case when event_id % 7 = 0 then 1 else 0.0001 end").alias("value")),
        precision=0,
    ),
    """WITH a AS (SELECT event_id, round(value, 0) AS value FROM events),
      b AS (SELECT event_id, round(value + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0.0001 END, 0) AS value FROM events)
    """ + EQ_SQL.format(c="event_id, value", a="a", b="b"),
)
add(
    "gt_05_equality_multiset", lambda d: generic.equality(d.tx, d.stg_tx, ["merchant_id", "status"], multiset=True),
    """SELECT 'a_minus_b' AS which_diff, merchant_id, status, count(*) AS n_rows FROM transactions
      WHERE status = 'cancelled' GROUP BY 2, 3""",
)
add(
    "gt_06_expression_is_true", lambda d: ids(generic.expression_is_true(d.tx, "amount > 50000 or installment_count > 4")),
    f"SELECT {ID} FROM transactions WHERE NOT (amount > 50000 OR installment_count > 4)",
)
add(
    "gt_06_expression_on_column", lambda d: ids(generic.expression_is_true(d.tx, "< 400", "decision_latency_ms")),
    f"SELECT {ID} FROM transactions WHERE NOT (decision_latency_ms < 400)",
)
add(
    "gt_07_fewer_rows_than", lambda d: generic.fewer_rows_than(d.stg_tx, d.tx, ["merchant_id"]),
    f"""SELECT merchant_id, count_b AS count_a, count_a AS count_b, CASE WHEN count_b > count_a THEN count_b - count_a ELSE 1 END AS row_count_delta
      FROM {PAIRED} WHERE count_b >= count_a""",
)
add(
    "gt_07_fewer_rows_fails", lambda d: generic.fewer_rows_than(d.tx, d.stg_tx, ["merchant_id"]),
    f"""SELECT *, CASE WHEN count_a > count_b THEN count_a - count_b ELSE 1 END AS row_count_delta
      FROM {PAIRED} WHERE count_a >= count_b""",
)


def _ranges(d: Data):
    """Open periods between the purchases of a user, one in nineteen stretched over the next."""
    src = d.tx.select("user_id", ID, F.to_date("created_at").alias("lo"))
    nxt = with_next(src, ["user_id"], ["lo", ID], ["lo"], "_n")
    end = F.coalesce(F.col("_n.lo"), F.date_add("lo", 30))
    return nxt.select("user_id", ID, "lo", F.when(F.col(ID) % 19 == 0, F.date_add(end, 5)).otherwise(end).alias("hi"))


RANGES = f"""(SELECT user_id, {ID}, lo, CASE WHEN {ID} % 19 = 0 THEN e + 5 ELSE e END AS hi FROM (
  SELECT user_id, {ID}, created_at::DATE AS lo, coalesce(lead(created_at::DATE) OVER (PARTITION BY user_id
  ORDER BY created_at::DATE, {ID}), created_at::DATE + 30) AS e FROM transactions))"""


def _ranges_sql(inner: str, meets: str) -> str:
    return f"""SELECT user_id, lo, hi, nx AS next_lo FROM (SELECT *, lead(lo) OVER w AS nx FROM {RANGES}
      WINDOW w AS (PARTITION BY user_id ORDER BY lo, hi)) WHERE NOT (coalesce({inner}, false) AND coalesce({meets}, nx IS NULL))"""


add(
    "gt_08_exclusive_ranges",
    lambda d: generic.mutually_exclusive_ranges(_ranges(d).drop(ID), "lo", "hi", ["user_id"]),
    _ranges_sql("lo < hi", "hi <= nx"),
)
add(
    "gt_08_exclusive_ranges_no_gaps",
    lambda d: generic.mutually_exclusive_ranges(
        _ranges(d).drop(ID), "lo", "hi", ["user_id"], gaps="not_allowed", zero_length_range_allowed=True
    ),
    _ranges_sql("lo <= hi", "hi = nx"),
)
add(
    "gt_08_exclusive_ranges_gaps_required",
    lambda d: generic.mutually_exclusive_ranges(_ranges(d).drop(ID), "lo", "hi", ["user_id"], gaps="required"),
    _ranges_sql("lo < hi", "hi < nx"),
)
add(
    "gt_09_not_accepted_values", lambda d: generic.not_accepted_values(d.tx, "status", ["cancelled", "refunded"]),
    "SELECT DISTINCT status FROM transactions WHERE status IN ('cancelled', 'refunded')",
)
add(
    "gt_10_not_constant", lambda d: generic.not_constant(d.tx, "currency", ["merchant_id"]),
    "SELECT merchant_id, min(currency) AS only_value FROM transactions GROUP BY 1 HAVING count(DISTINCT currency) = 1",
)
BLANK = "case when doc_id % 6 = 0 then '  ' when doc_id % 6 = 1 then null else lang end"
add(
    "gt_11_not_empty_string",
    lambda d: generic.not_empty_string(d.raw("documents").select("doc_id", F.expr(BLANK).alias("lang")), "lang").select("doc_id"),
    f"SELECT doc_id FROM documents WHERE trim({BLANK}) = ''",
)
add(
    "gt_12_not_null_proportion", lambda d: generic.not_null_proportion(d.tx, "decision_latency_ms", 0.98, group_by=["merchant_id"]),
    """SELECT merchant_id, round(count(decision_latency_ms)::DOUBLE / count(*), 6) AS not_null_proportion FROM transactions
      GROUP BY 1 HAVING count(decision_latency_ms)::DOUBLE / count(*) < 0.98""",
)
add(
    "gt_13_recency", lambda d: generic.recency(d.tx, "created_at", "day", 60, d.now, group_by=["user_id"]),
    f"SELECT user_id, max(created_at) AS most_recent FROM transactions GROUP BY 1 HAVING max(created_at) < {T_AS_OF} - INTERVAL 60 DAY",
)
add(
    "gt_13_recency_dates",
    lambda d: generic.recency(d.tx, "created_at", "day", 60, d.now, ignore_time_component=True, group_by=["user_id"]),
    f"""SELECT user_id, max(created_at::DATE) AS most_recent FROM transactions GROUP BY 1
      HAVING max(created_at::DATE) < ({T_AS_OF} - INTERVAL 60 DAY)::DATE""",
)
add(
    "gt_14_relationships_where",
    lambda d: generic.relationships_where(d.repay, ID, d.tx, ID, "status = 'paid'", "status = 'approved'"),
    f"""SELECT {ID} AS missing_key, count(*) AS n_records FROM repayments WHERE status = 'paid' AND {ID} NOT IN
      (SELECT {ID} FROM transactions WHERE status = 'approved') GROUP BY 1""",
)
add(
    "gt_15_sequential_values",
    lambda d: generic.sequential_values(d.versions.select(ID, "installment_number"), "installment_number", group_by=[ID]),
    f"""SELECT {ID}, installment_number, p AS previous_installment_number FROM (SELECT {ID}, installment_number,
      lag(installment_number) OVER (PARTITION BY {ID} ORDER BY installment_number) AS p FROM repayment_versions)
      WHERE NOT (installment_number = p + 1)""",
)


@query(
    "gt_15_sequential_minutes",
    """SELECT slot, p AS previous_slot FROM (SELECT slot, lag(slot) OVER (ORDER BY slot) AS p FROM
      (SELECT DISTINCT date_trunc('minute', created_at)::TIMESTAMP AS slot FROM app_events))
      WHERE NOT (slot = p + INTERVAL 1 MINUTE)""",
)
def _slots(d: Data):
    slots = d.events.select(F.date_trunc("minute", "created_at").cast("timestamp_ntz").alias("slot")).distinct()
    return generic.sequential_values(slots, "slot", datepart="minute")


add(
    "gt_16_unique_combination", lambda d: generic.unique_combination_of_columns(d.tx, ["user_id", "merchant_id", "status"]),
    "SELECT user_id, merchant_id, status, count(*) AS n_records FROM transactions GROUP BY 1, 2, 3 HAVING count(*) > 1",
)


@query("gt_08_scd2_invariant", "SELECT user_id, credit_tier, valid_from, valid_to, valid_from AS next_valid_from FROM (SELECT user_id, credit_tier, TIMESTAMP '2001-01-01' AS valid_from, TIMESTAMP '2001-05-01' AS valid_to FROM users) WHERE false")
def _scd_invariant(d: Data):
    """Versions of a key never overlap: the check over a real snapshot is empty."""
    then = d.users.select("user_id", F.expr("case when user_id % 3 = 0 then 'standard' else credit_tier end").alias("credit_tier"))
    at = [F.lit(t).cast("timestamp_ntz") for t in ("2001-01-01 00:00:00", "2001-05-01 00:00:00")]
    first = scd2.scd2_check(then, None, "user_id", ["credit_tier"], at[0])
    snap = scd2.scd2_check(d.users.select("user_id", "credit_tier"), first, "user_id", ["credit_tier"], at[1])
    far = F.lit("2099-01-01 00:00:00").cast("timestamp_ntz")
    closed = snap.withColumn("valid_to", F.coalesce("valid_to", far))
    return generic.mutually_exclusive_ranges(closed, "valid_from", "valid_to", ["user_id"])


# -- expectations: kernels -------------------------------------------------------------------------------------

add(
    "ex_01_expression_is_true", lambda d: ids(expect.expression_is_true(d.tx, "amount < 300000", row_condition="status = 'approved'")),
    f"SELECT {ID} FROM transactions WHERE status = 'approved' AND NOT (amount < 300000)",
)
add(
    "ex_01_grouped_expression",
    lambda d: expect.expression_is_true(d.tx, "sum(amount) < 30000000", group_by=["merchant_id"]),
    "SELECT merchant_id, false AS expression FROM transactions GROUP BY 1 HAVING NOT (sum(amount) < 30000000)",
)
add(
    "ex_02_expression_between",
    lambda d: expect.expression_between(d.tx, F.avg(F.col("amount").cast("double")), 150000, 210000, ["merchant_id"]),
    """SELECT merchant_id, round(avg(amount::DOUBLE), 6) AS measured FROM transactions GROUP BY 1
      HAVING NOT (avg(amount::DOUBLE) >= 150000 AND avg(amount::DOUBLE) <= 210000)""",
)
OTHER = """SELECT coalesce(a.g, b.g) AS col_1, a.x AS expression, b.x AS compare_expression,
  abs(coalesce(a.x, 0) - coalesce(b.x, 0)) AS expression_difference,
  round(abs(coalesce(a.x, 0) - coalesce(b.x, 0))::DOUBLE / nullif(a.x, 0)::DOUBLE, 6) AS expression_difference_percent
  FROM (SELECT {ga} AS g, {xa} AS x FROM {a} GROUP BY 1) a FULL JOIN (SELECT {gb} AS g, {xb} AS x FROM {b} GROUP BY 1) b
  ON a.g IS NOT DISTINCT FROM b.g WHERE abs(coalesce(a.x, 0) - coalesce(b.x, 0)) > {tol}"""
SCALAR = """SELECT a.x AS expression, b.x AS compare_expression, abs(a.x - b.x) AS expression_difference,
  round(abs(a.x - b.x)::DOUBLE / nullif(a.x, 0)::DOUBLE, 6) AS expression_difference_percent
  FROM (SELECT {xa} AS x FROM {a}) a, (SELECT {xb} AS x FROM {b}) b WHERE abs(a.x - b.x) > 0"""
add(
    "ex_03_equal_expression",
    lambda d: expect.equal_expression(d.tx, F.count(F.lit(1)), d.events, F.count(F.lit(1)), ["user_id"]),
    OTHER.format(ga="user_id", xa="count(*)", a="transactions", gb="user_id", xb="count(*)", b="app_events", tol=0),
)
add(
    "ex_03_equal_expression_tolerance",
    lambda d: expect.equal_expression(
        d.tx, F.count(F.lit(1)), d.events, F.count(F.lit(1)), ["user_id"], tolerance=20
    ),
    OTHER.format(
        ga="user_id", xa="count(*)", a="transactions", gb="user_id", xb="count(*)", b="app_events", tol=20,
    ),
)
add(
    "ex_03_equal_expression_percent",
    lambda d: expect.equal_expression(
        d.tx, F.count(F.lit(1)), d.stg_tx, group_by=["merchant_id"], tolerance_percent=0.2
    ),
    """SELECT m AS col_1, a AS expression, b AS compare_expression, a - b AS expression_difference,
      round((a - b)::DOUBLE / a, 6) AS expression_difference_percent FROM (SELECT merchant_id AS m, count(*) AS a,
      count(*) FILTER (status <> 'cancelled') AS b FROM transactions GROUP BY 1) WHERE (a - b)::DOUBLE / a > 0.2""",
)
NULLED = "case when user_id % 4 = 0 then null else merchant_id end"
add(
    "ex_04_ignore_row_if",
    lambda d: ids(d.tx.select(ID, F.expr(NULLED).alias("m"), "decision_latency_ms").where(
        expect.ignore_row_if(["m", "decision_latency_ms"], "any_value_is_missing"))),
    f"SELECT {ID} FROM transactions WHERE NOT (({NULLED}) IS NULL OR decision_latency_ms IS NULL)",
)
add(
    "ex_05_truth_expression",
    lambda d: d.tx.select(ID, expect.truth_expression("amount > 100000").alias("expression")),
    f"SELECT {ID}, amount > 100000 AS expression FROM transactions",
)

# -- shape and recency --------------------------------------------------------------------------------------------

LATE = "TIMESTAMP '2002-02-01 00:00:00'"
add(
    "ex_06_recent_data",
    lambda d: expect.recent_data(d.tx, "created_at", "day", 30, F.lit("2002-02-01 00:00:00").cast("timestamp_ntz")),
    f"SELECT max(created_at) AS most_recent FROM transactions WHERE created_at <= {LATE} HAVING max(created_at) < {LATE} - INTERVAL 30 DAY",
)
add(
    "ex_07_grouped_recent_data", lambda d: expect.grouped_recent_data(d.tx, ["user_id"], "created_at", "day", 90, d.now),
    f"""SELECT user_id, max(created_at) AS most_recent FROM transactions WHERE created_at <= {T_AS_OF} GROUP BY 1
      HAVING max(created_at) < {T_AS_OF} - INTERVAL 90 DAY""",
)
add(
    "ex_08_aggregation_equal", lambda d: expect.aggregation_equal(d.tx, F.max("user_id"), d.events),
    SCALAR.format(xa="max(user_id)", a="transactions", xb="max(user_id)", b="app_events"),
)
add(
    "ex_09_row_count_between", lambda d: expect.row_count_between(d.tx, 7, 13, ["user_id"]),
    "SELECT user_id, count(*) AS measured FROM transactions GROUP BY 1 HAVING count(*) NOT BETWEEN 7 AND 13",
)
add(
    "ex_10_row_count_equal", lambda d: expect.row_count_equal(d.tx, 10, ["user_id"]),
    "SELECT user_id, count(*) AS measured FROM transactions GROUP BY 1 HAVING count(*) <> 10",
)
add(
    "ex_11_row_count_equal_other", lambda d: expect.row_count_equal_other(d.tx, d.stg_tx),
    SCALAR.format(xa="count(*)", a="transactions", xb="count(*)", b="stg_transactions"),
)
add(
    "ex_12_row_count_times_factor", lambda d: expect.row_count_times_factor(d.versions, d.tx, 3),
    SCALAR.format(xa="count(*)", a="repayment_versions", xb="count(*) * 3", b="transactions"),
)

# expectations on the files of stored tables: the table, the expectation, the issues it must find
SHAPE = {
    "ex_13_column_to_exist": ("transactions", lambda: stored.column_exists("channel"), [("column_exists", "channel", "present", "missing")]),
    "ex_14_column_count_between": ("transactions", lambda: stored.column_count_between(1, 5), [("column_count", "*", "1..5", "9")]),
    "ex_15_column_count_equal": ("transactions", lambda: stored.column_count_equal(10), [("column_count", "*", "10..10", "9")]),
    "ex_17_columns_contain_set": ("transactions", lambda: stored.columns_contain(["amount", "fee"]), [("column_exists", "fee", "present", "missing")]),
    "ex_18_columns_match_set": (
        "amount-status", lambda: stored.columns_match_set(["amount", "fee"]),
        [("column_exists", "fee", "present", "missing"), ("column_extra", "status", "missing", "present")],
    ),
    "ex_19_columns_match_ordered_list": (
        "status-amount", lambda: stored.columns_match_ordered(["amount", "status"]),
        [("column_position", "amount", "amount", "status"), ("column_position", "status", "status", "amount")],
    ),
    "ex_20_columns_not_contain_set": ("transactions", lambda: stored.columns_not_contain(["amount", "fee"]), [("column_banned", "amount", "missing", "present")]),
    "ex_27_expect_type": ("transactions", lambda: stored.type_in("amount", ["double"]), [("column_type", "amount", "double", "decimal(12,2)")]),
    "ex_28_expect_type_in": ("transactions", lambda: stored.type_in("status", ["int", "bigint"]), [("column_type", "status", "int|bigint", "string")]),
}


def _files(d: Data):
    """Files of the stored tables."""
    build = {
        "transactions": lambda: d.tx, "amount-status": lambda: d.tx.select("amount", "status"),
        "status-amount": lambda: d.tx.select("status", "amount"), "installments": lambda: d.schedules,
    }
    return stored.files_of({name: d.stored(name, make) for name, make in build.items()})


def _shape_sql(rows) -> str:
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)
    return f"""SELECT v.*, (SELECT count(*) FROM transactions) AS table_rows FROM (VALUES {values})
      v("check", column_name, expected, found)"""


def _issues(d: Data, table: str, *expectations):
    found = stored.issues(_files(d), {table: expectations})
    return found.select("check", "column_name", "expected", "found", F.col("file_rows").alias("table_rows"))


for _name, (_table, _fn, _rows) in SHAPE.items():
    add(_name, lambda d, t=_table, f=_fn: _issues(d, t, f()), _shape_sql(_rows))
add(
    "ex_16_column_count_equal_other",
    lambda d: _issues(d, "transactions", stored.column_count_equal(stored.columns_of(_files(d).where("table_name = 'installments'")))),
    _shape_sql([("column_count", "*", "8..8", "9")]),
)


@query(
    "ex_13_schema_of_mixed_files",
    """SELECT * FROM (SELECT "check", column_name, expected, found, (SELECT count(*) FROM transactions WHERE year(created_at) = y) AS file_rows
      FROM (VALUES ('column_exists', 'currency', 'present', 'missing', 1996), ('column_type', 'amount', 'decimal(12,2)', 'double', 1997),
        ('column_extra', 'note', 'missing', 'present', 1998)) v("check", column_name, expected, found, y))""",
)
def _mixed(d: Data):
    """A table to which three years were written with a column less, another type and a column more."""

    def build(year: int):
        rows = d.tx.where(F.year("created_at") == year).select("transaction_id", "amount", "currency")
        return {
            1996: rows.drop("currency"), 1997: rows.withColumn("amount", F.col("amount").cast("double")), 1998: rows.withColumn("note", F.lit("x")),
        }.get(year, rows)

    files = stored.files_of({f"year-{y}": d.stored(f"mixed-{y}", lambda y=y: build(y)) for y in range(1995, 1999)})
    contract = [stored.columns_match_set(["transaction_id", "amount", "currency"]), stored.type_in("amount", ["decimal(12,2)"])]
    return stored.issues(files.withColumn("table_name", F.lit("payments")), {"payments": contract}).drop("table_name", "files")


# -- column values ----------------------------------------------------------------------------------------------------

add(
    "ex_21_values_between", lambda d: ids(expect.values_between(d.tx, "amount", 1000, 400000, "status = 'pending'")),
    f"SELECT {ID} FROM transactions WHERE status = 'pending' AND NOT (amount >= 1000 AND amount <= 400000)",
)
add(
    "ex_22_values_in_set", lambda d: ids(expect.values_in_set(d.tx, "decision_latency_ms", [60, 61, 62])),
    f"SELECT {ID} FROM transactions WHERE decision_latency_ms IS NULL OR decision_latency_ms NOT IN (60, 61, 62)",
)
add(
    "ex_22_values_in_large_set",
    lambda d: ids(expect.values_in_set(d.tx, "user_id", d.events.select("user_id"))),
    f"SELECT {ID} FROM transactions WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM app_events)",
)
add(
    "ex_23_values_not_in_set", lambda d: ids(expect.values_not_in_set(d.tx, "status", ["cancelled"])),
    f"SELECT {ID} FROM transactions WHERE status IN ('cancelled')",
)
add("ex_24_values_null", lambda d: d.versions.transform(lambda x: expect.values_null(x, "paid_at", "status = 'PAID'")).groupBy("status").count().withColumnRenamed("count", "n"),
    "SELECT status, count(*) AS n FROM repayment_versions WHERE status = 'PAID' AND paid_at IS NOT NULL GROUP BY 1")
add("ex_25_values_not_null", lambda d: ids(expect.values_not_null(d.tx, "decision_latency_ms")),
    f"SELECT {ID} FROM transactions WHERE decision_latency_ms IS NULL")
add("ex_26_unique", lambda d: expect.unique(d.tx, "user_id"),
    "SELECT user_id, count(*) AS n_records FROM transactions WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")


def _lagged(col: str, src: str, order: str, test: str, group: str = "") -> str:
    part = f"PARTITION BY {group} " if group else ""
    return f"SELECT {ID}, v AS value_lag FROM (SELECT *, lag({col}) OVER ({part}ORDER BY {order}) AS v FROM {src}) WHERE NOT ({col} {test} v)"


add(
    "ex_29_increasing",
    lambda d: expect.values_increasing(
        d.tx.select(ID, "decision_latency_ms"), "decision_latency_ms", [ID], row_condition="decision_latency_ms is not null"
    ).select(ID, "value_lag"),
    _lagged("decision_latency_ms", "(SELECT * FROM transactions WHERE decision_latency_ms IS NOT NULL)", ID, ">"),
)
add(
    "ex_29_increasing_grouped",
    lambda d: expect.values_increasing(
        d.tx.select("user_id", ID, "created_at"), "created_at", [ID], strictly=False, group_by=["user_id"]
    ).select(ID, "value_lag"),
    _lagged("created_at", "transactions", ID, ">=", "user_id"),
)
add(
    "ex_30_decreasing",
    lambda d: expect.values_decreasing(
        d.tx.select("user_id", ID, "installment_count"), "installment_count", [ID], group_by=["user_id"]
    ).select(ID, "value_lag"),
    _lagged("installment_count", "transactions", ID, "<", "user_id"),
)
CASED = "case when doc_id % 3 = 0 then upper(source) else source end"
add(
    "ex_31_consistent_casing",
    lambda d: expect.consistent_casing(d.raw("documents").select(F.expr(CASED).alias("source")), "source"),
    f"SELECT lower(s) AS lower_value, count(DISTINCT s) AS n_variants FROM (SELECT {CASED} AS s FROM documents) GROUP BY 1 HAVING count(DISTINCT s) > 1",
)

add(
    "ex_31_consistent_casing_display",
    lambda d: expect.consistent_casing(d.raw("documents").select(F.expr(CASED).alias("source")), "source", display=True),
    f"""SELECT lower(source) AS lower_value, source, n_rows FROM (SELECT s AS source, count(*) AS n_rows
      FROM (SELECT {CASED} AS s FROM documents) GROUP BY 1) QUALIFY count(*) OVER (PARTITION BY lower(source)) > 1""",
)

# -- several columns -----------------------------------------------------------------------------------------------------

add("ex_32_a_greater_than_b", lambda d: ids(expect.a_greater_than_b(d.tx, "decision_latency_ms", "merchant_id")),
    f"SELECT {ID} FROM transactions WHERE NOT (decision_latency_ms > merchant_id)")
add("ex_33_pair_equal", lambda d: expect.pair_equal(d.repay, "updated_at", "paid_at").select("repayment_id"),
    "SELECT repayment_id FROM repayments WHERE NOT (updated_at = paid_at)")
PAIRS = [("approved", 1), ("approved", 6), ("pending", 1), ("declined", 4)]
add(
    "ex_34_pair_in_set", lambda d: ids(expect.pair_in_set(d.tx, "status", "installment_count", PAIRS)),
    f"SELECT {ID} FROM transactions WHERE (status, installment_count) NOT IN (" + ", ".join(str(p) for p in PAIRS) + ")",
)
add(
    "ex_35_compound_unique", lambda d: expect.compound_unique(d.versions, [ID, "installment_number"]),
    f"SELECT {ID}, installment_number, count(*) AS n_records FROM repayment_versions GROUP BY 1, 2 HAVING count(*) > 1",
)
add(
    "ex_36_multicolumn_sum",
    lambda d: expect.multicolumn_sum(d.tx, ["installment_count", "merchant_id"], F.count(F.lit(1)) * 50, ["status"]),
    """SELECT status, (sum(installment_count) + sum(merchant_id))::BIGINT AS measured, count(*) * 50 AS expected FROM transactions
      GROUP BY 1 HAVING sum(installment_count) + sum(merchant_id) <> count(*) * 50""",
)
add(
    "ex_37_unique_within_record",
    lambda d: ids(expect.unique_within_record(d.tx, ["merchant_id", "installment_count", "user_id"])),
    f"SELECT {ID} FROM transactions WHERE merchant_id = installment_count OR merchant_id = user_id OR installment_count = user_id",
)

# -- aggregates --------------------------------------------------------------------------------------------------------------


def _agg_sql(expr: str, test: str, group: str = "merchant_id", src: str = "transactions", digits: str | None = None) -> str:
    shown = f"round(({expr})::DOUBLE, {digits})" if digits else expr
    return f"SELECT {group}, {shown} AS measured FROM {src} GROUP BY 1 HAVING {test.format(x=expr)}"


M = ["merchant_id"]
add("ex_38_distinct_count_gt", lambda d: expect.distinct_count_greater(d.tx, "user_id", 142, M),
    _agg_sql("count(DISTINCT user_id)", "NOT ({x} > 142)"))
add("ex_39_distinct_count_lt", lambda d: expect.distinct_count_less(d.tx, "user_id", 142, M),
    _agg_sql("count(DISTINCT user_id)", "NOT ({x} < 142)"))
add("ex_40_distinct_count_eq", lambda d: expect.distinct_count_equal(d.tx, "user_id", 142, M),
    _agg_sql("count(DISTINCT user_id)", "{x} <> 142"))
add("ex_41_distinct_count_eq_other", lambda d: expect.distinct_count_equal_other(d.tx, "user_id", d.events, "user_id"),
    SCALAR.format(xa="count(DISTINCT user_id)", a="transactions", xb="count(DISTINCT user_id)", b="app_events"))
add("ex_42_distinct_values_in_set", lambda d: expect.distinct_values_in_set(d.tx, "status", ["approved", "declined"]),
    "SELECT DISTINCT status AS value_field FROM transactions WHERE status NOT IN ('approved', 'declined')")
add("ex_43_distinct_values_contain_set", lambda d: expect.distinct_values_contain_set(d.tx, "status", ["approved", "refunded", "frozen"]),
    """SELECT v AS value_field FROM (VALUES ('approved'), ('refunded'), ('frozen')) s(v)
      WHERE v NOT IN (SELECT status FROM transactions)""")
add("ex_44_distinct_values_equal_set", lambda d: expect.distinct_values_equal_set(d.tx, "status", ["approved", "refunded"]),
    """SELECT DISTINCT status AS value_field, 'not_in_set' AS side FROM transactions WHERE status NOT IN ('approved', 'refunded')
      UNION ALL SELECT v, 'not_in_column' FROM (VALUES ('approved'), ('refunded')) s(v) WHERE v NOT IN (SELECT status FROM transactions)""")
add("ex_45_max_between", lambda d: expect.max_between(d.tx, "amount", 100000, 495000, M),
    _agg_sql("max(amount)", "NOT ({x} >= 100000 AND {x} <= 495000)", digits="2"))
add("ex_46_min_between", lambda d: expect.min_between(d.tx, "amount", 2000, 5000, M),
    _agg_sql("min(amount)", "NOT ({x} >= 2000 AND {x} <= 5000)", digits="2"))
add("ex_47_mean_between", lambda d: expect.mean_between(d.tx, "decision_latency_ms", 265, 285, M),
    _agg_sql("avg(decision_latency_ms)", "NOT ({x} >= 265 AND {x} <= 285)", digits="6"))
add("ex_48_median_between", lambda d: expect.median_between(d.tx, "decision_latency_ms", 265, 285, M),
    _agg_sql("median(decision_latency_ms)", "NOT ({x} >= 265 AND {x} <= 285)", digits="6"))
add("ex_49_quantile_between", lambda d: expect.quantile_between(d.tx, "decision_latency_ms", 0.95, 470, 480, M),
    _agg_sql("quantile_cont(decision_latency_ms, 0.95)", "NOT ({x} >= 470 AND {x} <= 480)", digits="6"))
add("ex_50_stdev_between", lambda d: expect.stdev_between(d.tx, "decision_latency_ms", 125, 132, M),
    _agg_sql("stddev_samp(decision_latency_ms)", "NOT ({x} >= 125 AND {x} <= 132)", digits="6"))
add("ex_51_sum_between", lambda d: expect.sum_between(d.tx, "installment_count", 600, 750, M),
    _agg_sql("sum(installment_count)::BIGINT", "NOT ({x} >= 600 AND {x} <= 750)"))
add("ex_52_unique_value_count_between", lambda d: expect.unique_value_count_between(d.tx, "user_id", 141, 144, M),
    _agg_sql("count(DISTINCT user_id)", "{x} NOT BETWEEN 141 AND 144"))
add("ex_53_unique_proportion_between", lambda d: expect.unique_proportion_between(d.tx, "user_id", 0.94, 0.97, M),
    _agg_sql("count(DISTINCT user_id)::DOUBLE / count(user_id)", "{x} NOT BETWEEN 0.94 AND 0.97", digits="6"))
add(
    "ex_54_most_common_in_set", lambda d: expect.most_common_in_set(d.tx, "status", ["declined"], top_n=1),
    """SELECT status AS value_field, n AS value_count, 1 AS value_count_rank FROM (SELECT status, count(*) AS n FROM transactions
      GROUP BY 1 ORDER BY n DESC, status LIMIT 1) WHERE status NOT IN ('declined')""",
)

# -- text: whole documents ---------------------------------------------------------------------------------------------------

DOC = "doc_id"


def docs(df):
    return df.select(DOC)


def text_check(name: str, fn, condition: str) -> None:
    add(name, lambda d: docs(fn(d.raw("documents"))), f"SELECT doc_id FROM documents WHERE {condition}")


text_check("ex_55_length_between", lambda x: expect.length_between(x, "text", 200, 2000), "NOT (length(text) >= 200 AND length(text) <= 2000)")
text_check("ex_56_length_equal", lambda x: expect.length_equal(x, "source", 5, "n_chars > 500"), "n_chars > 500 AND length(source) <> 5")
text_check("ex_57_match_regex", lambda x: expect.match_regex(x, "text", "[0-9]{3}"), "NOT regexp_matches(text, '[0-9]{3}')")
text_check("ex_57_match_regex_flags", lambda x: expect.match_regex(x, "text", "THE ", flags="i"), "NOT regexp_matches(text, '(?i)THE ')")
text_check("ex_58_not_match_regex", lambda x: expect.not_match_regex(x, "text", "@[a-z]+"), "regexp_matches(text, '@[a-z]+')")
text_check("ex_59_match_regex_list_any", lambda x: expect.match_regex_list(x, "text", ["[0-9]", "@"]), "NOT (regexp_matches(text, '[0-9]') OR regexp_matches(text, '@'))")
text_check("ex_59_match_regex_list_all", lambda x: expect.match_regex_list(x, "text", ["[0-9]", "@"], "all"), "NOT (regexp_matches(text, '[0-9]') AND regexp_matches(text, '@'))")
text_check("ex_60_not_match_regex_list_any", lambda x: expect.not_match_regex_list(x, "text", ["[0-9]", "@"]), "NOT (NOT regexp_matches(text, '[0-9]') OR NOT regexp_matches(text, '@'))")
text_check("ex_60_not_match_regex_list_all", lambda x: expect.not_match_regex_list(x, "text", ["[0-9]", "@"], "all"), "NOT (NOT regexp_matches(text, '[0-9]') AND NOT regexp_matches(text, '@'))")
text_check("ex_61_match_like", lambda x: expect.match_like(x, "text", "%the%"), "NOT (text LIKE '%the%')")
text_check("ex_62_not_match_like", lambda x: expect.not_match_like(x, "text", "%the%"), "text LIKE '%the%'")
text_check("ex_63_match_like_list", lambda x: expect.match_like_list(x, "text", ["%the%", "%ion%"], "all"), "NOT (text LIKE '%the%' AND text LIKE '%ion%')")
text_check("ex_64_not_match_like_list", lambda x: expect.not_match_like_list(x, "text", ["%the%", "%ion%"]), "NOT (text NOT LIKE '%the%' OR text NOT LIKE '%ion%')")

# -- distribution ---------------------------------------------------------------------------------------------------------------

add(
    "ex_65_within_n_stdevs", lambda d: expect.within_n_stdevs(d.tx, "amount", M, 1.5),
    """WITH s AS (SELECT merchant_id, sum(amount)::DOUBLE AS metric_value FROM transactions GROUP BY 1)
    SELECT merchant_id, round(metric_value, 6) AS metric_value, round((metric_value - a) / nullif(sd, 0), 6) AS sigma
      FROM s, (SELECT avg(metric_value) AS a, stddev_samp(metric_value) AS sd FROM s) WHERE abs((metric_value - a) / nullif(sd, 0)) > 1.5""",
)
add(
    "ex_66_within_n_moving_stdevs",
    lambda d: expect.within_n_moving_stdevs(
        d.events, "value", "created_at", d.events_now, ["event_type"], sigma_threshold=1.5, test_periods=20
    ).select("metric_period", "event_type", F.round("metric_test_sigma", 4).alias("metric_test_sigma")),
    """WITH g AS (SELECT date_trunc('day', created_at)::TIMESTAMP AS metric_period, event_type, sum(value) AS x FROM app_events GROUP BY 1, 2),
      p AS (SELECT *, lag(x, 1) OVER (PARTITION BY event_type ORDER BY metric_period) AS px FROM g),
      t AS (SELECT *, coalesce(ln(nullif(x, 0)), 0) - coalesce(ln(nullif(px, 0)), 0) AS v FROM p),
      c AS (SELECT *, avg(v) OVER w AS a, stddev_samp(v) OVER w AS s FROM t WINDOW w AS (PARTITION BY event_type
        ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT metric_period, event_type, round((v - a) / nullif(s, 0), 4) AS metric_test_sigma FROM c
      WHERE metric_period >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY AND metric_period < TIMESTAMP '2024-01-31'
      AND NOT ((v - a) / nullif(s, 0) >= -1.5 AND (v - a) / nullif(s, 0) <= 1.5)""",
)
SLOTS = """WITH b AS (SELECT date_trunc('minute', min(created_at))::TIMESTAMP AS lo, date_trunc('minute', max(created_at))::TIMESTAMP AS hi
    FROM app_events),
  s AS (SELECT unnest(generate_series(lo, hi, INTERVAL {n} MINUTE)) AS date_slot, hi, lo FROM b),
  used AS (SELECT DISTINCT lo + to_minutes((date_diff('minute', lo, date_trunc('minute', created_at)::TIMESTAMP) // {n}) * {n}) AS slot
    FROM app_events, b)
  SELECT date_slot, 0 AS row_cnt FROM s WHERE date_slot < hi AND date_slot NOT IN (SELECT slot FROM used)"""
add("ex_67_data_every_minute", lambda d: expect.data_every_n_datepart(d.events, "created_at", "minute"), SLOTS.format(n=1))
add("ex_67_data_every_5_minutes", lambda d: expect.data_every_n_datepart(d.events, "created_at", "minute", 5), SLOTS.format(n=5))
