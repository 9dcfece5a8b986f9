"""Point-in-time lookups: many (key, time) requests against versioned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.latest import latest_by
from tallyframe.operators.ordered import ROWS_PER_SEGMENT, place, with_last_known, with_previous, with_running_max
from tallyframe.session import shared_path


def asof_join(
    requests: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str | None,
    values: Sequence[str],
    tie: Sequence[str] = (),
    rows_per_segment: int = ROWS_PER_SEGMENT,
    overlapping: bool = True,
    unit: str = "day",
) -> DataFrame:
    """Attach to each request the newest version that started at or before it and is still open.

    Requests and versions become one ordered stream per key and the last version is carried forward, so work is one
    shuffle of their union: no pairs are formed, and a key with a third of all rows is cut into segments. If that
    version has ended, an older one may still be open. The stream also carries the latest end seen so far, which tells where that
    can be, and each version sees the one before it, which tells whether that one outlives its successor. Only those requests and
    those versions go to :func:`asof_range_join`; the stream is passed once.
    ``overlapping=False`` leaves that step out where ranges are known to be disjoint.
    """
    spark = requests.sparkSession
    columns = list(dict.fromkeys([valid_from, *([valid_to] if valid_to else []), *values]))
    body = F.struct(*dict.fromkeys([*columns, *tie]))
    order_cols = [F.col(t).alias(f"_tie_{i}") for i, t in enumerate(tie)]
    # a missing key equals nothing
    vers = versions.dropna(subset=list(keys)).select(
        *keys, F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), *order_cols,
        body.alias("_version"),
    )
    reqs = requests.select(
        *keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*requests.columns).alias("_request"),
    )
    order = ["_at", "_kind", *[f"_tie_{i}" for i in range(len(tie))]]
    stream = place(vers.unionByName(reqs, allowMissingColumns=True), keys, order, rows_per_segment)
    known = with_last_known(stream, keys, order, "_version", out="_hit")
    hit = F.col("_hit")
    open_ = F.lit(True)
    if valid_to:
        open_ = hit[valid_to].isNull() | (hit[valid_to] > F.col("_at"))
    answer = F.when(open_, hit)
    if not (valid_to and overlapping):
        found = known.where("_kind = 1").withColumn("_hit", answer)
        return found.select("_request.*", *[F.col("_hit")[c].alias(c) for c in columns])
    # a version without a start never begins, one without an end never ends
    end = F.when(F.col("_version").isNotNull() & F.col("_at").isNotNull(), F.struct(
        F.col("_version")[valid_to].isNull().alias("open"), F.col("_version")[valid_to].alias("end")
    ))
    ends = with_running_max(known.withColumn("_end", end), keys, order, "_end", out="_latest")
    maybe = F.col("_latest")["open"] | (F.col("_latest")["end"] > F.col("_at"))
    both = with_previous(ends, keys, order, ["_hit"], "_before")
    before = F.col("_before")["_hit"]
    # the version before this one, if it is open beyond the start of this one
    outlived = (F.col("_kind") == 0) & F.col("_at").isNotNull() & before[valid_from].isNotNull() & (
        before[valid_to].isNull() | (before[valid_to] > F.col("_at"))
    )
    asks = F.col("_kind") == 1
    path = shared_path(spark, "as-of")
    rows = both.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_request", F.when(asks, answer).alias("_hit"),
        F.when(asks, F.coalesce(maybe & answer.isNull(), F.lit(False))).alias("_older"),
        F.when(outlived, before).alias("_outlives"),
    ).where(F.col("_older").isNotNull() | F.col("_outlives").isNotNull())
    rows.write.parquet(path)
    found = spark.read.schema(rows.schema).parquet(path)
    asked = found.where("_older").select("_request").groupBy("_request").agg(F.count(F.lit(1)).alias("_n"))
    asked = asked.select("_request", "_n", F.col("_request")[at].alias("_at"), *[F.col("_request")[k].alias(k) for k in keys])
    outlives = found.where(F.col("_outlives").isNotNull()).select(
        *[F.col(f"_key_{i}").alias(k) for i, k in enumerate(keys)],
        *[F.col("_outlives")[c].alias(c) for c in dict.fromkeys([*columns, *tie]) if c not in keys],
    )
    older = asof_range_join(asked, outlives, keys, ["_request"], "_at", valid_from, valid_to, values, tie, unit)
    # equal requests were one, and become as many again
    older = older.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return found.where("not _older").select("_request.*", *[hit[c].alias(c) for c in columns]).unionByName(
        older.select("_request.*", *columns)
    )


# dyadic cells have 2^0 to 2^LEVELS units; a longer range is a row of cells of the largest kind
LEVELS = 16
_UNITS = {"hour": 3600, "day": 86_400}


def _unit_of(ts: str, unit: str) -> Column:
    seconds = F.unix_seconds(F.col(ts).cast("timestamp_ltz"))
    return F.floor(seconds / F.lit(float(_UNITS[unit]))).cast("bigint")


def dyadic_cells(first: Column, last: Column) -> Column:
    """The fewest dyadic cells that make up the units from ``first`` to ``last``: an array of ``(level, cell)``.

    On each level at most two cells are taken, an odd one where the range starts and an even one where it ends, so a range of n
    units costs at most 2 log2(n) rows.
    """

    def named(k: int):
        return lambda c: F.struct(F.lit(k).alias("level"), c.alias("cell"))

    def level(k: int) -> Column:
        low, high = F.shiftright(first + (1 << k) - 1, k), F.shiftright(last + 1, k)
        if k == LEVELS:
            none = F.array().cast("array<bigint>")
            return F.transform(F.when(low < high, F.sequence(low, high - 1)).otherwise(none), named(k))
        left = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), low)
        right = F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), high - 1)
        return F.transform(F.array_compact(F.array(left, right)), named(k))

    return F.concat(*[level(k) for k in range(LEVELS + 1)])


def cell_level(first: Column, last: Column) -> Column:
    """The smallest level k with 2^k units or more from ``first`` to ``last``: there the range touches one cell or two neighbours."""
    # the digits of last - first as a binary number, none for a range of one unit
    return F.when(last <= first, F.lit(0)).otherwise(F.length(F.bin(last - first)))


def _shifted(unit: str) -> Column:
    """The cell of a unit on the row's level."""
    return F.expr(f"shiftright({unit}, _level)")


def asof_range_join(
    requests: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    request_id: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    unit: str = "day",
) -> DataFrame:
    """The same lookup for validity ranges that may overlap freely.

    A range lies in one or two cells of the smallest level whose cells are at least as long, so it costs two rows at most, however long
    it is. A request looks up its cell on every level that any range uses, by equi-join on (key, level, cell); exact times are compared
    behind it. A hot key is spread over its cells, and the newest match per request is a mergeable ``max_by``.

    Cells multiply rows that lie compressed in small files, so the optimizer's estimate says nothing about their size: the join is
    a sort-merge join by hint, and no side of it is collected.
    """
    last = F.unix_seconds(requests.agg(F.max(at).alias("m")).scalar().cast("timestamp_ltz"))
    last = F.floor(last / F.lit(float(_UNITS[unit]))).cast("bigint")
    # a range ends where the last request asks; an empty or inverted one, or one that starts later, has no cell
    end = F.least(F.coalesce(_unit_of(valid_to, unit), last), last)
    valid = versions.where(F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))))
    placed = valid.withColumns({"_first": _unit_of(valid_from, unit), "_last": end}).where("_first <= _last").withColumn(
        "_level", cell_level(F.col("_first"), F.col("_last"))
    )
    # a list of a few small numbers
    levels = placed.agg(F.sort_array(F.collect_set("_level")).alias("l")).scalar()
    spans = placed.withColumn("_cell", F.explode(F.sequence(_shifted("_first"), _shifted("_last")))).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_level").alias("_vlevel"), F.col("_cell").alias("_vcell"),
        F.struct(valid_from, valid_to, *values).alias("_v"),
        F.struct(valid_from, *tie).alias("_rank"),
    ).hint("merge")
    ids = [F.col(c).alias(f"_r{i}") for i, c in enumerate(request_id)]
    asked = requests.where(F.col(at).isNotNull()).select(
        *ids, *keys, F.col(at).alias("_at"), _unit_of(at, unit).alias("_moment"), F.explode(levels).alias("_level")
    ).withColumn("_cell", _shifted("_moment"))
    cond = (F.col("_level") == F.col("_vlevel")) & (F.col("_cell") == F.col("_vcell"))
    cond = cond & (F.col("_v")[valid_from] <= F.col("_at"))
    cond = cond & (F.col("_v")[valid_to].isNull() | (F.col("_v")[valid_to] > F.col("_at")))
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_k{i}"))
    best = (
        asked.join(spans, cond, "inner")
        .groupBy(*[f"_r{i}" for i in range(len(request_id))])
        .agg(F.max_by("_v", "_rank").alias("_hit"))
    )
    back = F.lit(True)
    for i, c in enumerate(request_id):
        back = back & (F.col(c) == F.col(f"_r{i}"))
    return requests.join(best, back, "left").select(
        *requests.columns, *[F.col("_hit")[c].alias(c) for c in [valid_from, valid_to, *values]]
    )


def latest_per_key(
    versions: DataFrame, keys: Sequence[str], valid_from: str, tie: Sequence[str | Column] = ()
) -> DataFrame:
    return latest_by(versions, keys, [valid_from, *tie])


def asof_or_latest(
    requests: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
) -> DataFrame:
    """As-of value, else the newest version of the key; ``match`` says which one answered."""
    found = asof_join(requests, versions, keys, at, valid_from, valid_to, values, tie)
    cols = [valid_from, valid_to, *values]
    newest = latest_per_key(versions, keys, valid_from, tie).select(
        *keys, F.struct(*cols).alias("_latest")
    )
    joined = found.join(newest, list(keys), "left")
    hit = F.col(valid_from).isNotNull()
    return joined.select(
        *requests.columns,
        *[F.when(hit, F.col(c)).otherwise(F.col("_latest")[c]).alias(c) for c in cols],
        F.when(hit, "as_of").when(F.col("_latest").isNotNull(), "latest").otherwise("none").alias("match"),
    )
