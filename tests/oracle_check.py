"""Run registered queries beside their SQL and compare rows. Usage: oracle_check.py [prefix ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return ("f", round(v, 5) + 0.0)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, datetime.datetime):
        return ("t", v.isoformat())
    if isinstance(v, datetime.date):
        return ("d", v.isoformat())
    return v


def compare(df, con, sql):
    cols = sorted(df.columns)
    got = Counter(tuple(canon(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    if sorted(names) != cols:
        return f"columns differ: {cols} vs {sorted(names)}", 0
    odd = [(x[0], str(x[1])) for x in cur.description if "HUGE" in str(x[1]) or "DECIMAL" in str(x[1]) or "TIME ZONE" in str(x[1])]
    if odd:
        return f"types without a Spark twin: {odd}", 0
    idx = [names.index(c) for c in cols]
    want = Counter(tuple(canon(r[i]) for i in idx) for r in cur.fetchall())
    if got != want:
        a, b = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows differ: {sum(got.values())} vs {sum(want.values())}\n   {cols}\n   spark {a}\n   sql   {b}", sum(got.values())
    return None, sum(got.values())


def main(prefixes):
    import duckdb

    from tallyframe.catalog import ORACLES, QUERIES
    from tallyframe.session import build_session

    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad, slow = [], []
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in ORACLES:
                problem, n = compare(df, con, ORACLES[name])
            else:
                problem, n = None, df.count()
        except Exception as e:
            problem, n = "".join(traceback.format_exception_only(type(e), e))[:900], 0
        took = time.time() - t0
        slow.append((took, name))
        if problem:
            bad.append(name)
            print(f"BAD {name} {took:.1f}s: {problem}", flush=True)
        elif n == 0 or "-v" in os.environ.get("CHECK_FLAGS", ""):
            print(f"ok  {name} {took:.1f}s rows={n} {'oracle' if name in ORACLES else 'rows-only'}", flush=True)
    print(f"{len(slow)} run, {len(bad)} bad: {bad}")
    print("slowest:", [(n, round(t, 1)) for t, n in sorted(slow, reverse=True)[:12]])
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
