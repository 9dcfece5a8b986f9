"""The driver contract: every query is registered with unique, stable columns; a sample meets its SQL."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallyframe.catalog import ORACLES, QUERIES
from tests.oracle_check import TABLES, compare

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "mart_01_merchant_daily_kpis", "mart_03_settlement_reconciliation", "mart_05_risk_dashboard", "join_01_transaction_enriched",
    "join_08_anti", "join_10_as_of", "scd_04_from_log", "feat_11_compute_features", "dq_14_declared_checks",
    "gt_08_exclusive_ranges", "ex_66_within_n_moving_stdevs", "dt_04_fiscal_periods", "rpt_04_web_attribution",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns[0] == "merchant_id"


def test_registry_is_complete():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    # the training-data operators have tests of their own
    queries, oracles = QUERIES, ORACLES
    assert set(queries) <= set(entry_module.queries())
    without = set(queries) - set(oracles)
    assert all("approx" in n for n in without), without
    kinds = {n.split("_")[0] for n in queries}
    assert {
        "src", "snk", "cdc", "stg", "pred", "join", "mart", "agg", "win", "top", "set", "fn", "str", "inc", "scd", "feat",
        "drift", "dq", "gt", "ex", "tu", "dt", "eu", "mon", "alert", "rpt",
    } <= kinds


def test_the_rest_works_where_a_package_of_the_operators_is_missing():
    """Without a package that only the training-data operators need, their queries are left out and nothing else."""
    code = (
        "import sys; sys.modules['xxhash'] = None\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    )
    root = str(Path(entry_module.__file__).resolve().parent)
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(QUERIES)), "False"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_meets_its_sql(spark, con, name):
    problem, _ = compare(entry_module.queries()[name](spark, SF), con, entry_module.oracle_sql()[name])
    assert problem is None, problem
