"""Exact and approximate quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# bits of the ordered value that one pass decides
_BITS = 16
_SHIFTS = range(64 - _BITS, -1, -_BITS)


def ordered_bits(value: Column) -> Column:
    """A long that orders like the double: its exponent and fraction, negated below zero; NaN is the largest value."""
    size = F.abs(value)
    two = F.lit(2.0)
    # the logarithm may miss the exponent by one beside a power of two
    near = F.greatest(F.floor(F.log2(size)).cast("double"), F.lit(-1022.0))
    part = size / F.pow(two, near)
    exact = F.when(part >= 2, near + 1).when((part < 1) & (near > -1022), near - 1).otherwise(near)
    unit = F.lit(1 << 52)
    bits = (exact + 1022).cast("bigint") * unit + (size / F.pow(two, exact) * F.lit(float(1 << 52))).cast("bigint")
    whole = F.when(size == 0, F.lit(0).cast("bigint")).when(F.isnan(value), F.lit((2047 << 52) + 1)).when(
        size == float("inf"), F.lit(2047 << 52)
    ).otherwise(bits)
    return F.when(value < 0, -whole).otherwise(whole)


def exact_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], group_by: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles by radix selection, one column per ``{name: q}``.

    Rows are counted per value once. The first pass counts the highest 16 bits of the ordered values of each group; running
    counts tell in which cell each wanted rank lies. Three more passes count 16 bits each, of the chosen cells only, so the last
    one has the value itself. Nothing is sorted as a whole and nothing is read while the query is built; a group has at most
    65,536 cells per pass, whatever its size, and counts are summed before the shuffle. Groups without a value are left out.
    """
    group = list(group_by)
    value = F.col(column).cast("double")
    counts = df.where(F.col(column).isNotNull()).groupBy(*group, value.alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows")
    ).withColumn("_bits", ordered_bits(F.col("_value")))

    # the ranks below and above every quantile, and how far between them it lies
    total = F.col("_total")
    wanted = []
    for i, q in enumerate(probs.values()):
        place = F.lit(float(q)) * (total - 1)
        for t, rank in ((2 * i, F.floor(place)), (2 * i + 1, F.ceil(place))):
            wanted.append(F.struct(F.lit(t).alias("t"), rank.alias("rank"), (place - F.floor(place)).alias("part")))

    def choose(cells: DataFrame, targets: Column, within: list[str]) -> DataFrame:
        """Cells that hold a wanted rank, with the ranks counted from the start of the cell."""
        along = Window.partitionBy(*within).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = cells.withColumn("_upto", F.sum("_n").over(along))
        before = F.col("_upto") - F.col("_n")
        here = F.filter(targets, lambda x: (x["rank"] >= before) & (x["rank"] < F.col("_upto")))
        kept = F.transform(here, lambda x: F.struct(x["t"].alias("t"), (x["rank"] - before).alias("rank"), x["part"].alias("part")))
        return upto.withColumn("_kept", kept).where(F.size("_kept") > 0)

    names = [f"_g{i}" for i in range(len(group))]
    cells = counts.groupBy(*group, F.shiftright("_bits", _SHIFTS[0]).alias("_cell")).agg(F.sum("_rows").alias("_n"))
    # without groups the window holds at most 65,536 rows
    cells = cells.withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
    chosen = choose(cells, F.array(*wanted), group)
    for last, shift in zip(_SHIFTS[:-1], _SHIFTS[1:], strict=True):
        chosen = chosen.select(*[F.col(g).alias(n) for g, n in zip(group, names, strict=True)], F.col("_cell").alias("_prefix"), "_kept")
        on = F.shiftright(F.col("_bits"), last) == F.col("_prefix")
        for g, n in zip(group, names, strict=True):
            on = on & F.col(g).eqNullSafe(F.col(n))
        cells = counts.join(chosen, on).groupBy(
            *group, "_prefix", F.col("_kept").alias("_wanted"), F.shiftright("_bits", shift).alias("_cell")
        ).agg(F.sum("_rows").alias("_n"), F.max("_value").alias("_value"))
        chosen = choose(cells, F.col("_wanted"), [*group, "_prefix"])
    found = chosen.withColumn("_x", F.explode("_kept"))
    pick = lambda t: F.max(F.when(F.col("_x.t") == t, F.col("_value")))
    part = lambda t: F.max(F.when(F.col("_x.t") == t, F.col("_x.part")))
    low_high = found.groupBy(*group).agg(
        *[f(t).alias(f"_{c}{i}") for i in range(len(probs)) for c, f, t in (("lo", pick, 2 * i), ("hi", pick, 2 * i + 1), ("part", part, 2 * i))]
    )
    # equal neighbours are the value itself, also where their difference is not a number
    return low_high.select(*group, *[
        F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(
            F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")
        ).alias(name)
        for i, name in enumerate(probs)
    ])


def approx_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], group_by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The bounded-memory twin for dashboards."""
    return df.groupBy(*group_by).agg(
        *[F.approx_percentile(column, q, accuracy).alias(n) for n, q in probs.items()]
    )
