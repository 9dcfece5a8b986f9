"""Streaming jobs. Each is a plain transformation plus a way to land its result exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import cdc
from tallyframe.operators.latest import latest_by
from tallyframe.operators.ordered import ROWS_PER_SEGMENT, place, with_previous, with_running_sum
from tallyframe.plans.marts import exposure_partials
from tallyframe.sinks import exists, read_table, remove_folder, upsert_latest


def land(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    once: bool = True,
):
    """Start a query whose batches go through ``write_batch``; ``once`` drains what is there."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        query.awaitTermination()
    return query


def batch_folder(path: str, batch_id: int) -> str:
    """Rows of one micro-batch live in one folder, so a replayed batch replaces itself."""
    return f"{path}/batch={batch_id}"


def land_batches(stream: DataFrame, path: str, mode: str = "append", once: bool = True):
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(batch_folder(f"{path}/data", batch_id))

    return land(stream, write, f"{path}/_checkpoint", mode, once)


def landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data")


def settled(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Final rows of an update-mode aggregate: per key the row of the newest batch."""
    return latest_by(landed(spark, path), keys, ["batch"]).drop("batch")


# -- ingestion ------------------------------------------------------------------------------------

TYPERS = {
    "transactions": cdc.type_transactions,
    "repayments": cdc.type_repayments,
    "users": cdc.type_users,
    "merchants": cdc.type_merchants,
    "installments": cdc.type_installments,
    "app_events": cdc.type_app_events,
    "merchant_sessions": cdc.type_merchant_sessions,
}


def raw_ingest(stream: DataFrame, table: str) -> DataFrame:
    """Typed raw rows with the ingestion time; the same function serves batch and stream."""
    return cdc.stamp_ingest(TYPERS[table](stream))


def write_raw(stream: DataFrame, path: str, checkpoint: str, ts: str = "created_at"):
    """Continuous append, partitioned by month."""
    return (
        stream.withColumn("month", F.date_format(ts, "yyyyMM"))
        .writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("month").trigger(availableNow=True).start()
    )


def silver_fanout(path: str, key: str = "transaction_id", table: str = "transactions"):
    """Batch writer: one read of the batch feeds silver, both audit logs and the exposure state."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            outputs = {
                "silver": cdc.silver_transactions(df),
                "delete_audit": cdc.delete_audit({table: (df, key)}),
                "update_audit": cdc.update_audit({table: (df, key)}),
                "exposure": exposure_partials(df, F.lit(batch_id)).drop("batch"),
            }
            for name, out in outputs.items():
                out.write.mode("overwrite").parquet(batch_folder(f"{path}/{name}", batch_id))
        finally:
            df.unpersist()

    return write


def streaming_exposure(stream: DataFrame) -> DataFrame:
    """Running approved money per user; land it in update mode."""
    return (
        stream.where(F.col("status") == "approved")
        .groupBy("user_id")
        .agg(F.sum("amount").cast("decimal(38,2)").alias("active_exposure"))
    )


def dedup_replays(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop replays of at-least-once delivery; state is bounded by the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# counting the keys of the state reads each key again before it is written
COUNT_KEYS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def keyed_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key as stream state: out-of-order and replayed versions change nothing, newer ones replace.

    Land it with :func:`land_state`: a batch reads and writes the state of its own keys and puts out only those.
    """
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return stream.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*").select(*stream.columns)


def land_state(stream: DataFrame, path: str, once: bool = True):
    """Land the changed keys of each batch; the state itself lies in RocksDB, so it may outgrow memory.

    Rows of a batch live in its own folder, so a replayed batch replaces itself. Read with :func:`current_state`. The progress of the
    query does not count the keys of the whole state.
    """
    spark, conf = stream.sparkSession, {STATE_STORE: ROCKSDB, COUNT_KEYS: "false"}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        return land_batches(stream, path, "update", once)
    finally:
        # a started query keeps the settings it was started with
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def current_state(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """One row per key: the newest of the folded table and the batches landed since; keys whose newest row is deleted are gone."""
    batches, folded = landed(spark, path), read_table(spark, f"{path}/folded")
    # a finished fold holds its batches, one row per key
    done = -1 if folded is None else max((f for f in _numbers(folded, "fold") if _finished(f"{path}/folded/fold={f}")), default=-1)
    if done >= 0:
        folded, batches = folded.where(F.col("fold") == done), batches.where(F.col("batch") > done)
    if done >= 0 and max(_numbers(landed(spark, path), "batch")) <= done:
        newest = folded.drop("fold")
    else:
        batches = batches.drop("batch")
        newest = latest_by(batches if folded is None else folded.drop("fold").unionByName(batches), keys, order)
    return newest if deleted is None else newest.where(~F.coalesce(deleted, F.lit(False)))


def _numbers(table: DataFrame, column: str) -> list[int]:
    return sorted(int(r[0]) for r in table.select(column).distinct().collect())


def _finished(folder: str) -> bool:
    """Whether the write of a folder has ended; without that mark it is read with the batches it came from."""
    return exists(f"{folder}/_SUCCESS")


def fold_state(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Fold landed batches into one table, so that reading costs the keys and not their changes. The stream may run on.

    The new fold is complete before the older one and the folded batches go; a run that fails between leaves rows twice, which the
    newest-per-key read takes as one.
    """
    batches = _numbers(landed(spark, path), "batch")
    if not batches:
        return
    rows = landed(spark, path).where(F.col("batch") <= batches[-1]).drop("batch")
    old = read_table(spark, f"{path}/folded")
    folds = [] if old is None else _numbers(old, "fold")
    both = rows if old is None else old.drop("fold").unionByName(rows)
    latest_by(both, keys, order).write.mode("overwrite").parquet(f"{path}/folded/fold={batches[-1]}")
    for f in folds:
        if f != batches[-1]:
            remove_folder(f"{path}/folded/fold={f}")
    # the newest batch stays: an empty folder has no schema
    for b in batches[:-1]:
        remove_folder(batch_folder(f"{path}/data", b))


def latest_state(path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64):
    """Batch writer: newest version per key in a table that other jobs read as it is, by rewriting the touched buckets.

    Replaying a batch changes nothing, because the newest version wins again. Where readers can take the newest row per
    key, :func:`keyed_state` costs the batch's keys only.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        upsert_latest(df.sparkSession, df, path, keys, order, buckets)

    return write


def split_dead_letters(path: str, context: str = "json"):
    """Batch writer: readable rows to one folder, unreadable ones with their text to another."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            bad = F.col("_corrupt_record").isNotNull()
            df.where(~bad).drop("_corrupt_record").write.mode("overwrite").parquet(
                batch_folder(f"{path}/good", batch_id)
            )
            df.where(bad).select(
                F.col("_corrupt_record").alias("payload"), F.lit(context).alias("context"),
                F.lit("unreadable record").alias("reason"),
            ).write.mode("overwrite").parquet(batch_folder(f"{path}/dead", batch_id))
        finally:
            df.unpersist()

    return write


# -- windows --------------------------------------------------------------------------------------

def guard_dates(df: DataFrame, ts: str, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Rows fit for a watermark, and the rest for the dead-letter table."""
    bad = cdc.bad_dates(df, ts, as_of)
    return df.where(~bad), df.where(bad)


# reasons of the dead-letter table
BAD_DATE, LATE = "bad date", "behind the watermark"


def land_timely(stream: DataFrame, path: str, ts: str, as_of: Column, delay: str = "1 hour", once: bool = True):
    """Land rows fit for event time below ``good``, and all others below ``dead`` with their reason; one ledger row per batch.

    A stateful operator drops rows behind its watermark without a trace. Here the watermark is kept in the ledger: the newest
    time of all earlier batches, less ``delay``. Rows behind it and rows with a missing, zero or far-future date (one such
    would move the watermark past all data) become dead letters, so rows in = rows landed + dead letters, batch by batch.
    A batch reads the ledger of earlier batches only, so a replay decides as before and replaces its own folders.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        ledger = read_table(spark, f"{path}/ledger")
        mark = None
        if ledger is not None:
            # as text, so that it keeps the session's time zone on its way
            mark = (F.max("newest") - F.expr(f"interval {delay}")).cast("string")
            mark = ledger.where(F.col("batch") < batch_id).agg(mark).first()[0]
        bad = F.coalesce(cdc.bad_dates(df, ts, as_of), F.lit(True))
        late = F.lit(False) if mark is None else F.col(ts) < F.lit(mark).cast(df.schema[ts].dataType)
        # the batch's numbers come from the pass that writes it
        seen = Observation()
        reason = F.when(bad, BAD_DATE).when(late, LATE)
        rows = df.withColumn("reason", reason)
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("reason").isNull()).alias("landed"),
            F.count_if(F.col("reason") == BAD_DATE).alias("bad"), F.count_if(F.col("reason") == LATE).alias("late"),
            F.max(F.when(F.col("reason").isNull(), F.col(ts))).alias("newest"),
        )
        # one write, one pass: the kind is the outer folder
        kind = F.when(F.col("reason").isNull(), "good").otherwise("dead")
        rows.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(batch_folder(f"{path}/rows", batch_id))
        m = seen.get
        # an empty batch leaves the watermark where it was
        row = [(m["rows_in"], m["landed"], m["bad"], m["late"], m["newest"])]
        kinds = f"rows_in long, landed long, bad long, late long, newest {df.schema[ts].dataType.simpleString()}"
        spark.createDataFrame(row, kinds).write.mode("overwrite").parquet(batch_folder(f"{path}/ledger", batch_id))

    return land(stream, write, f"{path}/_checkpoint", once=once)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: rows in, landed, bad, late, and the newest time landed."""
    return spark.read.parquet(f"{path}/ledger")


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").where("kind = 'dead'").drop("kind", "batch")


def timely_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows :func:`land_timely` has landed, as a stream for stateful jobs with the same delay: none of them comes late."""
    return spark.readStream.schema(schema).parquet(f"{path}/rows/batch=*/kind=good")


def land_sessions(
    spark: SparkSession, path: str, schema, ts: str, user: str = "user_id", gap: str = "30 minutes", delay: str = "1 hour"
):
    """Sessions of the landed rows, put out once the watermark has passed their end; state holds open sessions only."""
    sessions = sessionize(timely_stream(spark, path, schema), ts, user=user, gap=gap, delay=delay)
    return land_batches(sessions, f"{path}/sessions", "append")


def close_sessions(spark: SparkSession, path: str, schema, ts: str, gap: str = "30 minutes", delay: str = "1 hour") -> None:
    """Move the watermark past all open sessions with a row of nobody, behind the last event by more than gap and delay.

    For the end of a stream; later events before that time would come late.
    """
    newest = ledger(spark, path).agg(F.max("newest").alias("m")).select(
        (F.col("m") + F.expr(f"interval {gap}") + F.expr(f"interval {delay}") + F.expr("interval 1 second")).alias(ts)
    )
    columns = [F.col(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    newest.select(*columns).write.mode("overwrite").parquet(f"{path}/rows/batch=-1/kind=good")


def observed_batches(path: str, ts: str):
    """Batch writer: rows to ``data``, and one row of metrics per batch from the same pass to ``metrics``.

    ``newest`` is the newest event time of the batch and ``rows`` their number, so lag and rates need no scan of the table.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(ts).alias("oldest"), F.max(ts).alias("newest")).write.mode(
            "overwrite"
        ).parquet(batch_folder(f"{path}/data", batch_id))
        m, kind = seen.get, df.schema[ts].dataType.simpleString()
        df.sparkSession.createDataFrame([(m["rows"], m["oldest"], m["newest"])], f"rows long, oldest {kind}, newest {kind}").write.mode(
            "overwrite"
        ).parquet(batch_folder(f"{path}/metrics", batch_id))

    return write


def _timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a zoned timestamp; the watermark only matters on streams."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, delay) if df.isStreaming else out


def _bounds(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in df.columns if c != "window"],
    )


def ingest_rate(df: DataFrame, ts: str, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    timed = _timed(df, ts, delay)
    return _bounds(timed.groupBy(F.window(ts, width)).agg(F.count(F.lit(1)).alias("rows_in")))


def approval_rate_sliding(
    df: DataFrame, ts: str, width: str = "24 hours", slide: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    timed = _timed(df, ts, delay)
    return _bounds(
        timed.groupBy(F.window(ts, width, slide)).agg(
            F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "approved").alias("approved")
        )
    )


def minute_rates(df: DataFrame, ts: str, latency: str, delay: str = "5 minutes") -> DataFrame:
    timed = _timed(df, ts, delay)
    return _bounds(
        timed.groupBy(F.window(ts, "1 minute")).agg(
            F.count(F.lit(1)).alias("requests"), F.approx_percentile(latency, 0.99).alias("p99")
        )
    )


def sessionize(
    df: DataFrame, ts: str, session_id: str | None = None, user: str = "user_id", gap: str = "30 minutes",
    delay: str = "1 hour", rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """First and last event, count and seconds per session.

    Rows with a session id group by it. Without one, a pause longer than ``gap`` ends a user's session.
    Streams use session windows, merged on the map side first. A batch numbers the sessions with
    segmented look-back instead, because a batch session window would sort all events of a busy user
    in one task.
    """
    timed = _timed(df, ts, delay)
    one = F.lit(1).cast("bigint")
    if session_id:
        rows, keys = timed.withColumn("_n", one), [F.col(session_id)]
    elif df.isStreaming:
        rows, keys = timed.withColumn("_n", one), [F.col(user), F.session_window(ts, gap)]
    else:
        # one row per moment, so that both ordered steps see the same order
        moments = timed.where(F.col(ts).isNotNull()).groupBy(user, ts).agg(F.count(F.lit(1)).alias("_n"))
        placed = place(moments, [user], [ts], rows_per_segment)
        prev = with_previous(placed, [user], [ts], [ts], "_prev")
        pause = F.col("_prev").isNull() | (F.col(ts) > F.col("_prev")[ts] + F.expr(f"interval {gap}"))
        rows = with_running_sum(
            prev.withColumn("_start", pause.cast("int")), [user], [ts], "_start", "_session"
        )
        keys = [F.col(user), F.col("_session")]
    out = rows.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.sum("_n").alias("events"))
    return out.select(
        session_id or user,
        F.col("_lo").cast("timestamp_ntz").alias("first_event"),
        F.col("_hi").cast("timestamp_ntz").alias("last_event"),
        "events",
        (F.unix_seconds("_hi") - F.unix_seconds("_lo")).alias("duration_seconds"),
    )
