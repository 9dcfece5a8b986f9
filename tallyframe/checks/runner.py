"""Result rows of checks, the gate over them, and a declarative batch of column checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = [
    "check_time", "stage", "check_name", "check_type", "status", "details", "rows_checked", "rows_failed",
]


def result_row(
    measured: DataFrame,
    check_time: Column,
    stage: str,
    check_name: str,
    check_type: str,
    rows_checked: Column,
    rows_failed: Column,
    status: Column | None = None,
    details: Sequence[Column] = (),
    bad_status: str = "fail",
) -> DataFrame:
    """One result row from a one-row frame of measures."""
    outcome = F.when(rows_failed == 0, "pass").otherwise(bad_status) if status is None else status
    info = F.to_json(F.struct(*details)) if details else F.lit("{}")
    return measured.select(
        check_time.alias("check_time"), F.lit(stage).alias("stage"), F.lit(check_name).alias("check_name"),
        F.lit(check_type).alias("check_type"), outcome.alias("status"), info.alias("details"),
        rows_checked.cast("bigint").alias("rows_checked"), rows_failed.cast("bigint").alias("rows_failed"),
    )


def violations_to_result(
    violations: DataFrame, checked: DataFrame, check_time: Column, stage: str, check_name: str,
    check_type: str, severity: str = "fail",
) -> DataFrame:
    """Any violation frame as one result row."""
    total = checked.agg(F.count(F.lit(1)).alias("n")).scalar()
    measured = violations.agg(F.count(F.lit(1)).alias("failed")).withColumn("total", total)
    return result_row(
        measured, check_time, stage, check_name, check_type, F.col("total"), F.col("failed"), bad_status=severity
    )


def union_results(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rows)


def evaluate_gate(results: DataFrame, as_of: Column, window: str = "1 hour") -> DataFrame:
    """One row: number of failures inside the window and whether work may go on."""
    recent = results.where(F.col("check_time") > as_of - F.expr(f"interval {window}"))
    fails = F.count_if(F.col("status") == "fail")
    return recent.agg(fails.alias("fail_count"), (fails == 0).alias("gate_open"))


def run_summary(results: DataFrame) -> DataFrame:
    """Counts per status and the one status of the run."""
    counts = {s: F.count_if(F.col("status") == s) for s in ("pass", "warn", "fail", "skip")}
    return results.agg(
        *[c.alias(f"{s}_count") for s, c in counts.items()], F.count(F.lit(1)).alias("total")
    ).withColumn(
        "status",
        F.when(F.col("total") == 0, "skip").when(F.col("fail_count") > 0, "fail").otherwise("pass"),
    )


@dataclass
class TableChecks:
    """Checks declared for one table."""

    table: str
    not_null: Sequence[str] = ()
    accepted_values: dict[str, Sequence] = field(default_factory=dict)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)


def _results_of(id_: str, tests: Sequence[tuple[str, str, Column, Column, str]], check_time: Column, stage: str) -> Column:
    """The result rows of one id, as an array where the id matches."""
    rows = F.array(*[
        F.struct(
            check_time.alias("check_time"), F.lit(stage).alias("stage"), F.lit(name).alias("check_name"),
            F.lit(kind).alias("check_type"), F.when(failed == 0, "pass").otherwise(bad).alias("status"), F.lit("{}").alias("details"),
            total.cast("bigint").alias("rows_checked"), failed.cast("bigint").alias("rows_failed"),
        )
        for name, kind, total, failed, bad in tests
    ])
    return F.when(F.col("_id") == id_, rows)


def declared_checks(
    tables: dict[str, DataFrame], specs: Sequence[TableChecks], check_time: Column, stage: str = "silver"
) -> DataFrame:
    """Result rows of all declared checks, with one scan per table and one exchange of keys for all of them.

    A row of a table yields one entry with the outcomes of its column checks, one per relationship it is a child in, with its
    key, and one per relationship whose parent it is. Entries are summed per (id, key) before the shuffle, children and
    parents of all relationships together; a key that only children have is a violation with all their rows.
    """
    column_tests: dict[str, list[tuple[str, str, Column]]] = {}
    for s in specs:
        tests = column_tests.setdefault(s.table, [])
        tests += [("not_null", c, F.col(c).isNull()) for c in s.not_null]
        tests += [("accepted_values", c, ~F.col(c).isin(list(vs))) for c, vs in s.accepted_values.items()]
    # the widest table decides how many outcomes an entry can carry
    width = max(map(len, column_tests.values()), default=0)
    links = [(f"{s.table}.{c}", s.table, c, parent, key) for s in specs for c, (parent, key) in s.relationships.items()]

    def entry(id_: str, key: Column, child: int, parent: int, outcomes: Sequence[Column] = ()) -> Column:
        flags = [F.coalesce(o.cast("int"), F.lit(0)) for o in outcomes] + [F.lit(0)] * (width - len(outcomes))
        return F.struct(
            F.lit(id_).alias("_id"), key.cast("string").alias("_key"), F.lit(child).alias("_child"), F.lit(parent).alias("_parent"),
            *[f.alias(f"_bad{i}") for i, f in enumerate(flags)],
        )

    parts = []
    for name in dict.fromkeys([s.table for s in specs] + [parent for *_, parent, _ in links]):
        entries = []
        if name in column_tests:
            entries.append(entry(name, F.lit(None), 1, 1, [bad for _, _, bad in column_tests[name]]))
        # a missing key asks for no parent and is none
        entries += [F.when(F.col(c).isNotNull(), entry(id_, F.col(c), 1, 0)) for id_, table, c, _, _ in links if table == name]
        entries += [F.when(F.col(key).isNotNull(), entry(id_, F.col(key), 0, 1)) for id_, _, _, parent, key in links if parent == name]
        parts.append(tables[name].select(F.inline(F.array_compact(F.array(*entries)))))
    bads = [f"_bad{i}" for i in range(width)]
    by_key = union_results(parts).groupBy("_id", "_key").agg(
        F.sum("_child").alias("_child"), F.max("_parent").alias("_parent"), *[F.sum(b).alias(b) for b in bads]
    )
    wide = by_key.groupBy("_id").agg(
        F.sum("_child").alias("_total"), F.sum(F.when(F.col("_parent") == 0, F.col("_child")).otherwise(0)).alias("_orphans"),
        *[F.sum(b).alias(b) for b in bads],
    )
    # a table without rows has no entry, but its checks have a result
    every = [(table,) for table in column_tests] + [(id_,) for id_, *_ in links]
    ids = wide.sparkSession.createDataFrame(every, "_id string")
    wide = ids.join(wide, "_id", "left").na.fill(0)
    found = [
        _results_of(table, [(f"{table}.{c}", kind, F.col("_total"), F.col(f"_bad{i}"), "fail") for i, (kind, c, _) in enumerate(tests)], check_time, stage)
        for table, tests in column_tests.items() if tests
    ]
    found += [_results_of(id_, [(id_, "relationships", F.col("_total"), F.col("_orphans"), "warn")], check_time, stage) for id_, *_ in links]
    return wide.select(F.inline(F.coalesce(*found)))
