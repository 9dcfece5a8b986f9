"""Ordered look-back over groups of any size.

A plain ``lag`` or running sum over ``partitionBy(key)`` puts a hot key in one task, and without a key the whole
table. So rows are placed first: ranges of the whole tuple (keys, order columns), whatever its types, become segments
of about ``rows_per_segment`` rows. The window runs inside (key, segment), and one row per key and segment edge
carries a value over the edge. A busy day, a batch stamp or a common prefix is cut like anything else, because every
order column takes part; only rows that agree in all of them stay together. Only keys that could outgrow a segment are cut: keys
are counted by hash bucket, and the rows of buckets that fit one segment stay whole in segment 0, where the plain window
is the whole job. So most tables are shuffled once, by key. No key is listed and there is no limit to the hot ones.

The rows are stored in the shared folder first, so whatever computes them runs once, and the count of the stored rows gives
the number of segments. A range partitioning that is evaluated twice may cut differently, so the rows of cut keys are stored
again where they are placed. A frame without a cut key has no edges. All forms have the same types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyframe.session import shared_path

ROWS_PER_SEGMENT = 1_000_000

SEGMENT = "_scan_segment"
# the segment of the keys that are not cut
WHOLE = 0
# marks the column of a frame in which no key is cut
_SINGLE = {"single_segment": True}
# hash buckets of keys that are counted
_BUCKETS = 1 << 16


def place(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Add ``_scan_segment``: 0 for keys that fit one segment, else it rises with (keys, order). Look-back shares this placement."""
    spark = df.sparkSession
    rows = _stored(df, "rows-to-place")
    n = rows.count()
    # ranges follow a sample, so they are meant to hold half of what is allowed
    whole = F.lit(WHOLE).alias(SEGMENT, metadata=_SINGLE)
    if ceil(2 * n / rows_per_segment) <= 2:
        return rows.withColumn(SEGMENT, whole)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)) if keys else F.lit(0)
    sizes = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # each has more rows than a segment, so there are fewer than segments
    full = {r[0]: r[1] for r in sizes.where(F.col("_n") > rows_per_segment).collect()}
    # a task of the window sorts about as many rows as a segment has, however many there are
    tasks = max(ceil(2 * n / rows_per_segment), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not full:
        return rows.repartition(tasks, *keys).withColumn(SEGMENT, whole)
    cut = bucket.isin(list(full))
    hot = rows.where(cut).repartitionByRange(ceil(2 * sum(full.values()) / rows_per_segment), *keys, *order)
    hot = hot.withColumn(SEGMENT, F.spark_partition_id() + (WHOLE + 1))
    path = shared_path(spark, "placed-rows")
    hot.write.parquet(path)
    hot = spark.read.schema(hot.schema).parquet(path)
    return rows.where(~cut).withColumn(SEGMENT, F.lit(WHOLE)).unionByName(hot)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def _scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    inside,
    edge: Column,
    fold,
    combine,
    out: str,
    rows_per_segment: int,
    descending: bool = False,
) -> DataFrame:
    placed = SEGMENT in df.columns
    seg = df if placed else place(df, keys, order, rows_per_segment)
    by = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    local = seg.withColumn("_scan_local", inside(Window.partitionBy(*keys, SEGMENT).orderBy(*by)))
    kind = local.schema["_scan_local"].dataType
    columns = df.columns if placed else [c for c in seg.columns if c != SEGMENT]
    if seg.schema[SEGMENT].metadata == _SINGLE:
        return local.withColumn(out, F.col("_scan_local").cast(kind)).select(*columns, out)
    names = [f"_edge_{i}" for i in range(len(keys))]
    # keys that are not cut have no edge
    edges = seg.where(F.col(SEGMENT) > WHOLE).groupBy(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(SEGMENT).alias("_edge_seg")
    ).agg(edge.alias("_scan_edge"))
    along = Window.partitionBy(*names).orderBy(F.col("_edge_seg").desc() if descending else F.col("_edge_seg").asc())
    # only a key's later segments are entered by a value: segments rise with the key, so that is one row per segment at most
    carry = (
        edges.withColumn("_scan_carried", fold("_scan_edge", along))
        .withColumn("_edge_no", F.row_number().over(along)).where("_edge_no > 1").drop("_scan_edge", "_edge_no")
    )
    cond = _null_safe(local, carry, list(zip(keys, names, strict=True))) & (local[SEGMENT] == carry["_edge_seg"])
    return (
        local.join(F.broadcast(carry), cond, "left")
        .withColumn(out, combine(F.col("_scan_local"), F.col("_scan_carried")).cast(kind))
        .select(*columns, out)
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    out: str = "_prev",
    descending: bool = False,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add ``out``: a struct of ``values`` of the row before, NULL on a group's first row.

    ``order`` must be a total order inside a group for a repeatable answer. A frame that :func:`place` made for the same
    keys and order, or rows of it, keeps its placement and the column of it.
    """
    value = F.struct(*values)
    rank = F.struct(*order)
    edge = F.min_by(value, rank) if descending else F.max_by(value, rank)
    return _scan(
        df, keys, order,
        inside=lambda w: F.lag(value).over(w),
        edge=edge,
        fold=lambda c, w: F.lag(c).over(w),
        combine=lambda local, carried: F.coalesce(local, carried),
        out=out, rows_per_segment=rows_per_segment, descending=descending,
    )


def with_next(df, keys, order, values, out="_next", rows_per_segment=ROWS_PER_SEGMENT) -> DataFrame:
    """Mirror of :func:`with_previous`: the row after, NULL on a group's last row."""
    return with_previous(df, keys, order, values, out, True, rows_per_segment)


def with_last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "_last",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add ``out``: the newest non-NULL ``value`` up to and including the row."""
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    return _scan(
        df, keys, order,
        inside=lambda w: F.last(value, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
        edge=F.max_by(F.col(value), rank),
        fold=lambda c, w: F.last(c, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)
        ),
        combine=lambda local, carried: F.coalesce(local, carried),
        out=out, rows_per_segment=rows_per_segment,
    )


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "running",
    descending: bool = False,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` from the group's first row to this one, in the type of a plain sum."""
    return _scan(
        df, keys, order,
        inside=lambda w: F.sum(value).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
        edge=F.sum(value),
        fold=lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        combine=lambda local, carried: F.when(carried.isNull(), local)
        .when(local.isNull(), carried)
        .otherwise(local + carried),
        out=out, rows_per_segment=rows_per_segment, descending=descending,
    )


def with_running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "running",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add ``out``: the largest ``value`` from the group's first row to this one; NULL values are left out."""
    return _scan(
        df, keys, order,
        inside=lambda w: F.max(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        edge=F.max(value),
        fold=lambda c, w: F.max(c).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        combine=lambda local, carried: F.when(carried.isNull() | (local >= carried), local).otherwise(carried),
        out=out, rows_per_segment=rows_per_segment,
    )


def with_trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reach: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Columns that ``compute`` adds from a row and the ``reach`` rows of its key before it.

    ``compute`` gets rows and the window over a key in ``order``; frames and lags of the window may look back ``reach`` rows in
    all. Each segment is given the last rows of those before it (halo rows), at most ``reach`` per key, so
    that its frames are whole; halo rows are left out again. Which rows a segment needs follows from their places in the key,
    found by counts per segment and an equi-join on place over reach, also where a segment holds fewer rows than that.
    """
    seg = place(df, keys, order, rows_per_segment)
    by = [F.col(o).asc() for o in order]
    columns = [c for c in seg.columns if c != SEGMENT]
    if seg.schema[SEGMENT].metadata == _SINGLE:
        return compute(seg, Window.partitionBy(*keys).orderBy(*by)).drop(SEGMENT)
    names = [f"_halo_{i}" for i in range(len(keys))]
    sizes = seg.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(SEGMENT).alias("_halo_seg")).agg(
        F.count(F.lit(1)).alias("_halo_rows")
    )
    # at most one row per key and segment
    along = Window.partitionBy(*names).orderBy("_halo_seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_halo_start", F.coalesce(F.sum("_halo_rows").over(along), F.lit(0)))
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(*by)
    ranked = seg.withColumn("_halo_rank", F.row_number().over(inside) - 1)
    cond = _null_safe(ranked, starts, list(zip(keys, names, strict=True))) & (ranked[SEGMENT] == starts["_halo_seg"])
    placed = ranked.join(starts, cond).withColumn("_place", F.col("_halo_start") + F.col("_halo_rank"))
    last = placed.where(F.col("_halo_rows") - F.col("_halo_rank") <= reach).select(*columns, "_place")
    # a segment that starts at s needs the places from s - reach to s - 1
    last = last.withColumn("_cell", F.explode(F.array(F.expr(f"_place div {reach}"), F.expr(f"_place div {reach} + 1"))))
    heads = starts.where("_halo_start > 0").withColumn("_halo_cell", F.expr(f"_halo_start div {reach}"))
    cond = _null_safe(last, heads, list(zip(keys, names, strict=True))) & (F.col("_cell") == F.col("_halo_cell"))
    cond = cond & (F.col("_place") < F.col("_halo_start")) & (F.col("_place") >= F.col("_halo_start") - reach)
    halo = last.join(heads, cond).select(*columns, F.col("_halo_seg").alias(SEGMENT), F.lit(True).alias("_is_halo"))
    whole = placed.select(*columns, SEGMENT, F.lit(False).alias("_is_halo")).unionByName(halo)
    return compute(whole, Window.partitionBy(*keys, SEGMENT).orderBy(*by)).where("not _is_halo").drop(SEGMENT, "_is_halo")
