"""Point-in-time credit-risk features per user."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.scalars import clamp_far_future
from tallyframe.operators.asof import asof_or_latest

# Feature configuration: window in days, stored type and value for a user without rows.
FEATURES = {
    "tx_velocity_7d": {"days": 7, "type": "int", "default": 0, "kind": "count"},
    "tx_velocity_30d": {"days": 30, "type": "int", "default": 0, "kind": "count"},
    "avg_tx_amount_30d": {"days": 30, "type": "decimal(12,2)", "default": 0, "kind": "amount"},
    "repayment_rate_90d": {"days": 90, "type": "double", "default": 0, "kind": "rate"},
    "merchant_diversity_30d": {"days": 30, "type": "int", "default": 0, "kind": "count"},
    "declined_rate_7d": {"days": 7, "type": "double", "default": 0, "kind": "rate"},
    "active_installments": {"days": None, "type": "int", "default": 0, "kind": "count"},
    "days_since_first_tx": {"days": None, "type": "int", "default": 0, "kind": "count"},
}
FEATURE_NAMES = list(FEATURES)
RATE_FEATURES = [n for n, f in FEATURES.items() if f["kind"] == "rate"]


def _days(n: int) -> Column:
    return F.expr(f"interval {n} days")


def as_column(ts: datetime | str | Column) -> Column:
    return ts if isinstance(ts, Column) else F.lit(str(ts)).cast("timestamp_ntz")


def derive_snapshot_ts(tx: DataFrame, as_of: Column) -> DataFrame:
    """One row: the newest event time, clamped when it lies in the far future."""
    return tx.agg(F.max("created_at").alias("m")).select(
        clamp_far_future(F.col("m"), as_of).alias("snapshot_ts")
    )


def transaction_features(tx: DataFrame, at: Column) -> DataFrame:
    """Velocity, mean amount, diversity, decline rate and account age in one pass over the facts."""
    in7 = F.col("created_at") >= at - _days(FEATURES["tx_velocity_7d"]["days"])
    in30 = F.col("created_at") >= at - _days(FEATURES["tx_velocity_30d"]["days"])
    declined = in7 & (F.col("status") == "declined")
    return tx.where(F.col("created_at") <= at).groupBy("user_id").agg(
        F.count_if(in7).alias("tx_velocity_7d"),
        F.count_if(in30).alias("tx_velocity_30d"),
        F.round(F.avg(F.when(in30, F.col("amount"))), 2).alias("avg_tx_amount_30d"),
        F.count_distinct(F.when(in30, F.col("merchant_id"))).alias("merchant_diversity_30d"),
        F.try_divide(F.count_if(declined).cast("double"), F.count_if(in7)).alias("declined_rate_7d"),
        F.datediff(F.to_date(at), F.to_date(F.min("created_at"))).alias("days_since_first_tx"),
    )


def repayment_features(repay: DataFrame, at: Column) -> DataFrame:
    """Share of repayments due in the last 90 days that were paid by their due date."""
    day = F.to_date(at)
    due = repay.where(
        (F.col("due_date") >= F.date_sub(day, FEATURES["repayment_rate_90d"]["days"])) & (F.col("due_date") <= day)
    )
    on_time = F.col("paid_at").isNotNull() & (F.to_date("paid_at") <= F.col("due_date"))
    return due.groupBy("user_id").agg(
        F.try_divide(F.count_if(on_time).cast("double"), F.count(F.lit(1))).alias("repayment_rate_90d")
    )


def installment_features(schedules: DataFrame, at: Column) -> DataFrame:
    return (
        schedules.where((F.col("status") == "active") & (F.col("created_at") <= at))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("active_installments"))
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({
        n: F.coalesce(F.col(n), F.lit(f["default"])).cast(f["type"])
        for n, f in FEATURES.items() if n in df.columns
    })


def stamp_validity(df: DataFrame, at: Column, hours: int = 4, version: str = "v1") -> DataFrame:
    return df.withColumns({
        "snapshot_ts": at,
        "valid_from": at,
        "valid_to": at + F.expr(f"interval {hours} hours"),
        "feature_version": F.lit(version),
    })


def compute_features(
    tx: DataFrame,
    repay: DataFrame,
    schedules: DataFrame,
    snapshot_ts: datetime | str | Column,
    hours: int = 4,
    version: str = "v1",
) -> DataFrame:
    """All eight features of every user known at ``snapshot_ts``, using nothing that came later.

    Three aggregates, one per source, meet on the same key. Give a literal time where possible: it
    then reaches the scans as a pushed filter.
    """
    at = as_column(snapshot_ts)
    joined = (
        transaction_features(tx, at)
        .join(repayment_features(repay, at), "user_id", "left")
        .join(installment_features(schedules, at), "user_id", "left")
    )
    return stamp_validity(fill_defaults(joined), at, hours, version).select(
        "user_id", "snapshot_ts", "valid_from", "valid_to", "feature_version", *FEATURE_NAMES
    )


# The running totals a snapshot is made of, all long; a fact adds to them where it enters a window and takes away where it leaves.
# Money counts in whole cents: exact, half as wide as a decimal of 38 digits, and added without an object per row.
_TOTALS = ["n7", "declined7", "n30", "cents30", "merchants30", "due90", "on_time90", "active"]
_DAY = 86_400_000_000


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp_ltz"))


class SnapshotSeries:
    """Snapshot times ``start + k * step`` for k = 0, 1, ... up to ``end``, all in the plan: nothing is read to build it.

    Without bounds it starts at midnight of the first fact and ends with the first snapshot after the last one.
    """

    def __init__(self, tx: DataFrame, every_hours: int, start: datetime | str | None, end: datetime | str | None):
        self.step = every_hours * 3_600_000_000
        step = F.lit(self.step)
        if start is None:
            # pmod: midnight also for times before 1970
            lowest = _micros(tx.agg(F.min("created_at").alias("m")).scalar())
            self.start = lowest - F.pmod(lowest, F.lit(_DAY))
        else:
            self.start = _micros(as_column(start))
        until = _micros(as_column(end)) if end is not None else _micros(tx.agg(F.max("created_at").alias("m")).scalar()) + step
        self.last = self._floor(until)

    def _floor(self, micros: Column) -> Column:
        # rounded down also before the start; the quotient of whole steps is exact
        ahead = micros - self.start
        return ((ahead - F.pmod(ahead, F.lit(self.step))) / F.lit(self.step)).cast("bigint")

    def enters(self, micros: Column) -> Column:
        """The first snapshot that is not before a time."""
        return F.greatest(self._floor(micros + F.lit(self.step - 1)), F.lit(0).cast("bigint"))

    def leaves(self, micros: Column) -> Column:
        """The first snapshot after a time."""
        return self._floor(micros) + 1

    def time(self, k: Column) -> Column:
        return F.timestamp_micros(self.start + k * F.lit(self.step)).cast("timestamp_ntz")


def _event(at: Column, **changes: Column | int) -> Column:
    """A change of the running totals at a snapshot; ``created`` is the time of a transaction, NULL for other facts."""
    columns = {n: F.lit(changes.get(n, 0)) if isinstance(changes.get(n, 0), int) else changes[n] for n in _TOTALS}
    created = changes.get("created", F.lit(None).cast("timestamp_ntz"))
    return F.struct(
        at.alias("_k"), created.alias("_created"), *[c.cast("bigint").alias(n) for n, c in columns.items()]
    )


def _transaction_events(tx: DataFrame, series: SnapshotSeries) -> DataFrame:
    at = _micros(F.col("created_at"))
    placed = tx.withColumns({
        "_in": series.enters(at), "_out7": series.leaves(at + F.lit(7 * _DAY)), "_out30": series.leaves(at + F.lit(30 * _DAY)),
        "_no": F.when(F.col("status") == "declined", 1).otherwise(0),
    })
    enter, out7, out30 = F.col("_in"), F.col("_out7"), F.col("_out30")
    seen7, seen30 = F.when(out7 > enter, 1).otherwise(0), F.when(out30 > enter, 1).otherwise(0)
    cents = (F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(34,2)") * 100).cast("bigint")
    return placed.select("user_id", F.explode(F.array(
        _event(enter, created=F.col("created_at"), n7=seen7, declined7=seen7 * F.col("_no"), n30=seen30, cents30=seen30 * cents),
        _event(out7, n7=-seen7, declined7=-seen7 * F.col("_no")),
        _event(out30, n30=-seen30, cents30=-seen30 * cents),
    )).alias("_e")).select("user_id", "_e.*")


def _merchant_events(tx: DataFrame, series: SnapshotSeries) -> DataFrame:
    """A merchant counts while any of its transactions is in the window: the union of their stays.

    All stays are equally long, so of those that enter at one snapshot the last to leave stands for all, and a stay joins the
    one before if that has not left yet. A (user, merchant) has at most one row per snapshot.
    """
    at = _micros(F.col("created_at"))
    key = ["user_id", "merchant_id"]
    stays = tx.where("merchant_id is not null").select(
        *key, series.enters(at).alias("_in"), series.leaves(at + F.lit(30 * _DAY)).alias("_out")
    ).where("_out > _in").groupBy(*key, "_in").agg(F.max("_out").alias("_out"))
    along = Window.partitionBy(*key).orderBy("_in")
    joined = stays.withColumns({"_before": F.lag("_out").over(along), "_after": F.lead("_in").over(along)})
    first = F.when(F.coalesce(F.col("_before") < F.col("_in"), F.lit(True)), 1).otherwise(0)
    last = F.when(F.coalesce(F.col("_after") > F.col("_out"), F.lit(True)), 1).otherwise(0)
    return joined.select("user_id", F.explode(F.array(
        _event(F.col("_in"), merchants30=first), _event(F.col("_out"), merchants30=-last)
    )).alias("_e")).select("user_id", "_e.*")


def _repayment_events(repay: DataFrame, series: SnapshotSeries) -> DataFrame:
    due = _micros(F.col("due_date").cast("timestamp_ntz"))
    on_time = F.when(F.to_date("paid_at") <= F.col("due_date"), 1).otherwise(0)
    # due on the snapshot's day or on one of the 90 days before it
    placed = repay.where("due_date is not null").select(
        "user_id", series.enters(due).alias("_in"), series.leaves(due + F.lit(91 * _DAY - 1)).alias("_out"), on_time.alias("_ok")
    ).where("_out > _in")
    return placed.select("user_id", F.explode(F.array(
        _event(F.col("_in"), due90=1, on_time90=F.col("_ok")), _event(F.col("_out"), due90=-1, on_time90=-F.col("_ok"))
    )).alias("_e")).select("user_id", "_e.*")


def _installment_events(schedules: DataFrame, series: SnapshotSeries) -> DataFrame:
    return schedules.where("status = 'active' and created_at is not null").select(
        "user_id", _event(series.enters(_micros(F.col("created_at"))), active=1).alias("_e")
    ).select("user_id", "_e.*")


def compute_feature_history(
    tx: DataFrame,
    repay: DataFrame,
    schedules: DataFrame,
    every_hours: int = 4,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    hours: int = 4,
    version: str = "v1",
) -> DataFrame:
    """Features at every snapshot of a regular series, over the whole range of the transactions unless bounded.

    Each fact becomes an event at the snapshot where it enters a window and one at the snapshot where it leaves, so it costs two
    or three rows however many snapshots see it. Events are summed per user and snapshot before the shuffle; a running sum
    over a user's events gives the totals, and the totals of an event hold until the next one. A user has at most one event
    row per snapshot, so no group outgrows the series. The work is facts plus output, never facts times snapshots.
    Facts without a user or a time count for nobody.
    """
    series = SnapshotSeries(tx, every_hours, start, end)
    known = tx.where("user_id is not null and created_at is not null")
    events = (
        _transaction_events(known, series)
        .unionByName(_merchant_events(known, series))
        .unionByName(_repayment_events(repay, series))
        .unionByName(_installment_events(schedules, series))
    )
    steps = events.where(F.col("_k") <= series.last).groupBy("user_id", "_k").agg(
        F.min("_created").alias("_created"), *[F.sum(n).alias(n) for n in _TOTALS]
    )
    user = Window.partitionBy("user_id")
    along = user.orderBy("_k")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = steps.select(
        "user_id", "_k", F.min("_created").over(user).alias("_first"),
        F.min(F.when(F.col("_created").isNotNull(), F.col("_k"))).over(user).alias("_known"),
        F.coalesce(F.lead("_k").over(along), series.last + 1).alias("_next"),
        *[F.sum(n).over(upto).alias(n) for n in _TOTALS],
    )
    # the totals of an event hold until the next one, from the user's first transaction on
    since = F.greatest(F.col("_k"), F.col("_known"))
    rows = totals.where(F.col("_known").isNotNull() & (since < F.col("_next"))).withColumn(
        "_k", F.explode(F.sequence(since, F.col("_next") - 1))
    )
    at = series.time(F.col("_k"))
    # half a cent rounds away from zero; a quotient of longs
    mean = F.expr("if(n30 > 0, sign(cents30) * ((2 * abs(cents30) + n30) div (2 * n30)), null)").cast("bigint").cast("decimal(20,0)") / 100
    named = rows.withColumns({
        "_at": at, "tx_velocity_7d": F.col("n7"), "tx_velocity_30d": F.col("n30"), "avg_tx_amount_30d": mean.cast("decimal(38,2)"),
        "repayment_rate_90d": F.try_divide(F.col("on_time90").cast("double"), F.col("due90")),
        "merchant_diversity_30d": F.col("merchants30"),
        "declined_rate_7d": F.try_divide(F.col("declined7").cast("double"), F.col("n7")),
        "active_installments": F.col("active"), "days_since_first_tx": F.datediff(F.to_date(at), F.to_date("_first")),
    })
    return stamp_validity(fill_defaults(named), F.col("_at"), hours, version).select(
        "user_id", "snapshot_ts", "valid_from", "valid_to", "feature_version", *FEATURE_NAMES
    )


def valid_row() -> Column:
    """Whether a feature row may be served: nothing missing or negative, rates within [0, 1]."""
    ok = F.lit(True)
    for n in FEATURE_NAMES:
        ok = ok & F.coalesce(F.col(n) >= 0, F.lit(False))
    for n in RATE_FEATURES:
        ok = ok & F.coalesce(F.col(n) <= 1, F.lit(False))
    return ok


def serve_as_of(requests: DataFrame, features: DataFrame, version: str | None = None) -> DataFrame:
    """Features for a batch of ``(user_id, as_of)`` requests.

    A request without a time, or with one no version covers, gets the newest version; ``match``
    tells which, ``is_valid`` whether the values pass the ranges. ``request_id`` must be unique.
    """
    rows = features.where(F.col("feature_version") == version) if version else features
    found = asof_or_latest(
        requests, rows, ["user_id"], "as_of", "valid_from", "valid_to",
        ["snapshot_ts", "feature_version", *FEATURE_NAMES], tie=["snapshot_ts"],
    )
    return found.withColumn("is_valid", F.when(F.col("match") != "none", valid_row()))
