"""Table utilities: union, pivot, unpivot, keys, spines, bucketed and distance columns."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_relations(
    frames: dict[str, DataFrame],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    column_override: dict[str, str] | None = None,
    source_column: str | None = "source_name",
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns; a column a frame lacks is NULL there."""
    override = column_override or {}
    parts = []
    for name, df in frames.items():
        keep = [
            c for c in df.columns if (include is None or c in include) and c not in exclude
        ]
        part = df.where(where) if where else df
        part = part.select(*[F.col(c).cast(override[c]) if c in override else F.col(c) for c in keep])
        if source_column:
            part = part.select(F.lit(name).alias(source_column), "*")
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def pivot(
    df: DataFrame,
    group_by: Sequence[str],
    column: str,
    values: Sequence,
    agg=F.sum,
    then_value: Column | None = None,
    else_value: Column | None = None,
    prefix: str = "",
    suffix: str = "",
    cmp: str = "=",
) -> DataFrame:
    """One conditional aggregate per value; rows that do not compare add ``else_value``, not NULL."""
    compare = {
        "=": operator.eq, "<>": operator.ne, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt,
        ">=": operator.ge,
    }[cmp]
    then_value = F.lit(1) if then_value is None else then_value
    else_value = F.lit(0) if else_value is None else else_value
    return df.groupBy(*group_by).agg(
        *[
            agg(F.when(compare(F.col(column), F.lit(v)), then_value).otherwise(else_value)).alias(f"{prefix}{v}{suffix}")
            for v in values
        ]
    )


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str] | None = None,
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows with one common type."""
    cols = list(columns) if columns else [c for c in df.columns if c not in ids]
    typed = df.select(*ids, *[F.col(c).cast(cast_to).alias(c) for c in cols])
    return typed.unpivot(list(ids), cols, field_name, value_name)


def column_values(
    df: DataFrame, column: str, max_records: int | None = None, where: str | None = None
) -> DataFrame:
    """Distinct values, most frequent first."""
    src = df.where(where) if where else df
    out = src.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return out.limit(max_records) if max_records else out


# Fixed value: stands for NULL inside a key, so that keys stay equal across systems.
NULL_KEY_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_MARKER)) for c in columns]
    return F.md5(F.concat_ws("-", *parts).cast("binary"))


def nullcheck(df: DataFrame) -> DataFrame:
    """Empty text becomes NULL in every text column."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def nullcheck_cols(columns: Sequence[str]) -> list[Column]:
    return [F.nullif(F.col(c), F.lit("")).alias(c) for c in columns]


# slots that one row of the coarse level stands for
BLOCK = 10_000


def two_level_series(bounds: DataFrame, slots: Column, name: str = "generated_number") -> DataFrame:
    """The columns of a one-row frame with ``name`` counting 0, 1, ... up to ``slots`` - 1; nothing is read to build it.

    The row is cut into blocks, the blocks are dealt out over the tasks, and each task fills its blocks, so a spine of any
    length is made by many tasks and no row holds more than a block.
    """
    parts = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # an explicit number: blocks are a few bytes, and would be merged into one task again
    blocks = bounds.withColumn("_slots", slots).where(F.col("_slots") > 0).withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_slots - 1) div {BLOCK})"))
    ).repartition(parts, "_block")
    first = F.col("_block") * BLOCK
    filled = F.sequence(first, F.least(first + BLOCK, F.col("_slots")) - 1)
    return blocks.withColumn(name, F.explode(filled)).drop("_block", "_slots")


def date_spine(
    bounds: DataFrame, start: str, end: str, datepart: str = "day", inclusive: bool = False, name: str = "date_day", step: int = 1
) -> DataFrame:
    """One row per ``step`` date parts from ``start`` up to, not including, ``end`` of a one-row frame."""
    unit, kind = datepart.upper(), bounds.schema[start].dataType
    lo, hi = F.col(start).cast("timestamp_ntz"), F.col(end).cast("timestamp_ntz")
    # whole steps between the bounds, and one more unless the last of them is the excluded end
    whole = F.expr(f"timestampdiff({unit}, cast({start} as timestamp_ntz), cast({end} as timestamp_ntz)) div {step}")
    last = F.timestamp_add(unit, (whole * step).cast("int"), lo)
    slots = F.when(lo <= hi, whole + 1 if inclusive else F.when(last < hi, whole + 1).otherwise(whole)).otherwise(0)
    numbered = two_level_series(bounds.select(start, end), slots.cast("bigint"), "_slot")
    return numbered.select(F.timestamp_add(unit, (F.col("_slot") * step).cast("int"), lo).cast(kind).alias(name))


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def series_up_to(bounds: DataFrame, upper: str, name: str = "generated_number") -> DataFrame:
    """1, 2, ... up to the value of a one-row frame, which is read when the query runs."""
    slots = F.coalesce(F.col(upper).cast("bigint"), F.lit(0))
    return two_level_series(bounds.select(upper), slots, "_slot").select((F.col("_slot") + 1).alias(name))


def width_bucket(expr: Column, lo: float, hi: float, n: int) -> Column:
    """1..n inside [lo, hi), n + 1 from hi on, 0 below."""
    return F.width_bucket(expr, F.lit(float(lo)), F.lit(float(hi)), F.lit(n))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    # Earth radius in miles and kilometres per mile.
    radius, factor = 3961, {"mi": 1.0, "km": 1.60934}[unit]
    dlat, dlon = F.radians((lat2 - lat1) / 2), F.radians((lon2 - lon1) / 2)
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.asin(F.sqrt(h)) * (2 * radius * factor)


def safe_add(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def safe_subtract(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def safe_divide(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def star(df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    keep = filtered_columns(df, exclude)
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in keep])


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    dropped = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in dropped]


def single_value(df: DataFrame, value: Column, default) -> Column:
    """First cell of a one-row aggregate as a scalar, ``default`` when there is none."""
    return F.coalesce(df.agg(value.alias("v")).scalar(), F.lit(default))


def url_host(url: Column) -> Column:
    bare = F.regexp_replace(url, "android-app://|http://|https://", "")
    return F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url: Column) -> Column:
    bare = F.regexp_replace(url, "http://|https://", "")
    slash = F.instr(bare, "/")
    cut = F.when(slash > 0, slash).otherwise(F.instr(bare, "?") - 1)
    rest = F.when(cut >= 0, F.substring(bare, cut + 1, F.length(bare))).otherwise(bare)
    return F.split_part(rest, F.lit("?"), F.lit(1))


def url_parameter(url: Column, name: str) -> Column:
    after = F.split_part(url, F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))
