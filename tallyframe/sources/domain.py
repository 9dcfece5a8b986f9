"""Domain views over the driver's star-schema tables.

Each view is a column mapping ``{name: expression}``. The expressions use only syntax that means the
same in Spark SQL and in the checking engine, so one mapping serves the job and its oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import tune

TRANSACTIONS = {
    "transaction_id": "o_orderkey",
    "user_id": "o_custkey",
    "merchant_id": "cast(o_orderkey % 100 as int)",
    "amount": "cast(o_totalprice as decimal(12,2))",
    "currency": "'SAR'",
    "status": "case when o_orderpriority = '4-NOT SPECIFIED' then 'cancelled' "
    "when o_orderstatus = 'O' then 'pending' "
    "when o_orderpriority = '5-LOW' then 'declined' else 'approved' end",
    "decision_latency_ms": "case when o_orderkey % 37 = 0 then null "
    "else cast(50 + o_orderkey % 451 as int) end",
    "installment_count": "case when o_orderpriority = '1-URGENT' then 1 "
    "when o_orderpriority = '2-HIGH' then 6 when o_orderpriority = '3-MEDIUM' then 12 else 4 end",
    "created_at": "o_orderdate",
}

USERS = {
    "user_id": "c_custkey",
    "full_name": "c_name",
    "email": "lower(concat(replace(c_name, '#', '.'), '@mail.example'))",
    "credit_limit": "cast(abs(c_acctbal) as decimal(12,2))",
    "credit_tier": "case when c_mktsegment = 'BUILDING' then 'vip' "
    "when c_mktsegment = 'AUTOMOBILE' then 'premium' else 'standard' end",
    "kyc_status": "case when c_custkey % 20 = 0 then 'rejected' "
    "when c_custkey % 20 <= 2 then 'pending' else 'approved' end",
}

# read from supplier left join nation
MERCHANTS = {
    "merchant_id": "cast(s_suppkey as int)",
    "merchant_name": "s_name",
    "merchant_category": "case s_nationkey % 5 when 0 then 'electronics' when 1 then 'fashion' "
    "when 2 then 'groceries' when 3 then 'restaurants' else 'travel' end",
    "risk_tier": "case when s_suppkey % 10 < 6 then 'low' when s_suppkey % 10 < 9 then 'medium' "
    "else 'high' end",
    "commission_rate": "cast(0.01 + (s_suppkey % 90) / 1000.0 as decimal(5,4))",
    "credit_limit": "cast(abs(s_acctbal) as decimal(15,2))",
    "country": "n_name",
}

# read from lineitem left join orders; several versions per (transaction, installment)
REPAYMENT_VERSIONS = {
    "repayment_id": "l_orderkey * 10 + l_linenumber",
    "transaction_id": "l_orderkey",
    "user_id": "o_custkey",
    "installment_number": "l_linenumber",
    "amount": "cast(l_extendedprice as decimal(12,2))",
    "due_date": "cast(l_shipdate as date)",
    "paid_at": "case when l_returnflag = 'A' then l_shipdate + (l_partkey % 6) * interval '1' day end",
    "status": "case l_returnflag when 'A' then 'PAID' when 'R' then 'Overdue' else 'waived' end",
    "updated_at": "l_shipdate",
    "op": "case l_returnflag when 'A' then 'u' when 'R' then 'd' else 'c' end",
    "tie_part": "l_partkey",
    "tie_supp": "l_suppkey",
    "tie_qty": "l_quantity",
}

INSTALLMENTS = {
    "schedule_id": "o_orderkey",
    "transaction_id": "o_orderkey",
    "user_id": "o_custkey",
    "total_amount": "cast(o_totalprice as decimal(12,2))",
    "installment_count": TRANSACTIONS["installment_count"],
    "start_date": "cast(o_orderdate as date)",
    "status": "case o_orderstatus when 'F' then 'completed' when 'O' then 'active' else 'defaulted' end",
    "created_at": "o_orderdate",
}

APP_EVENTS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "event_data": "props",
    "value": "value",
    "created_at": "ts",
}

REQUEST_LOG = {
    "request_id": "event_id",
    "route": "event_type",
    "latency_ms": "value",
    "event_time": "ts",
}

# newest first, with a total order so that one version always wins
REPAYMENT_KEYS = ["transaction_id", "installment_number"]
REPAYMENT_VERSION_ORDER = ["updated_at", "tie_part", "tie_supp", "amount", "tie_qty"]


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in mapping.items()])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(raw(spark, sf_dir, "orders"), TRANSACTIONS)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(raw(spark, sf_dir, "customer"), USERS)


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = raw(spark, sf_dir, "supplier")
    nations = raw(spark, sf_dir, "nation")
    return project(
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey, "left"), MERCHANTS
    )


def repayment_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw(spark, sf_dir, "lineitem")
    orders = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return project(
        lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left"), REPAYMENT_VERSIONS
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(raw(spark, sf_dir, "orders"), INSTALLMENTS)


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(raw(spark, sf_dir, "events"), APP_EVENTS)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(raw(spark, sf_dir, "events"), REQUEST_LOG)
