"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

# Runtime settings every job of this package relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge a hot user's session windows on the map side, before the shuffle
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tallyframe", master: str | None = None, **conf) -> SparkSession:
    """A session for tests and the benchmark; a cluster passes its own."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # building large plans is much faster without a call-site lookup per column
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@contextmanager
def finer_shuffles(spark: SparkSession, rows: int, rows_per_task: int = 100_000):
    """While it is open, shuffles of started jobs have a partition per ``rows_per_task`` rows of the input, merged up to 16 MB.

    A fixed number of partitions gives a task more to sort and to hold, the larger the tables are.
    """
    plain = int(spark.conf.get("spark.sql.shuffle.partitions"))
    conf = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(plain, ceil(rows / rows_per_task))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyframe-")
    return f"{base.rstrip('/')}/tallyframe/{label}-{uuid.uuid4().hex}"
