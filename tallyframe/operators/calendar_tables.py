"""Date dimension and fiscal calendars; one row per day, so small beside any fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import calendar as C
from tallyframe.operators.tables import date_spine


def base_dates(
    bounds: DataFrame, start: str, end: str, datepart: str = "day"
) -> DataFrame:
    """Spine over a one-row frame of bounds, end excluded."""
    return date_spine(bounds, start, end, datepart, name=f"date_{datepart}")


def recent_base_dates(bounds: DataFrame, as_of: str, n: int, datepart: str = "day") -> DataFrame:
    """The last ``n`` parts, the present one included."""
    part = F.date_trunc(datepart, F.col(as_of))
    with_bounds = bounds.select(
        (part - F.expr(f"interval {n - 1} {datepart}")).alias("_lo"),
        (part + F.expr(f"interval 1 {datepart}")).alias("_hi"),
    )
    return date_spine(with_bounds, "_lo", "_hi", datepart, name=f"date_{datepart}")


def date_dimension(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes of each day: neighbours, the prior year, and the start, end, number and
    name of its week, month, quarter and year."""
    d = F.to_date(F.col(day))
    prior_year, prior_twin = F.add_months(d, -12), F.date_sub(d, 364)
    cols: dict[str, Column] = {
        "date_day": d,
        "prior_date_day": C.yesterday(d),
        "next_date_day": C.tomorrow(d),
        "prior_year_date_day": prior_year,
        "prior_year_over_year_date_day": prior_twin,
        "day_of_week": C.day_of_week(d, isoweek=False),
        "day_of_week_iso": C.day_of_week(d, isoweek=True),
        "day_of_week_name": C.day_name(d, short=False),
        "day_of_week_name_short": C.day_name(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
    }
    for prefix, x in (("", d), ("prior_year_", prior_twin)):
        cols[f"{prefix}week_start_date"] = C.week_start(x)
        cols[f"{prefix}week_end_date"] = C.week_end(x)
        cols[f"{prefix}week_of_year"] = C.week_of_year(x)
        cols[f"{prefix}iso_week_start_date"] = C.iso_week_start(x)
        cols[f"{prefix}iso_week_end_date"] = C.iso_week_end(x)
        cols[f"{prefix}iso_week_of_year"] = C.iso_week_of_year(x)
    cols |= {
        "month_of_year": F.month(d),
        "month_name": C.month_name(d, short=False),
        "month_name_short": C.month_name(d),
        "month_start_date": C.month_start(d),
        "month_end_date": F.last_day(d),
        "prior_year_month_start_date": C.month_start(prior_year),
        "prior_year_month_end_date": F.last_day(prior_year),
        "quarter_of_year": F.quarter(d),
        "quarter_start_date": C.quarter_start(d),
        "quarter_end_date": C.quarter_end(d),
        "year_number": F.year(d),
        "year_start_date": C.year_start(d),
        "year_end_date": C.year_end(d),
    }
    return days.select(*[e.alias(n) for n, e in cols.items()])


def fiscal_year_dates(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Fiscal years that end on the week end closest to a month end.

    Candidate week ends are those of the weeks starting in the closing month. Days meet their year
    by a range condition on a table of one row per year, and their week by arithmetic.
    """
    closing = dates.where(F.col("month_of_year") == year_end_month).select(
        (F.col("year_number") - shift_year).alias("fiscal_year_number"),
        "month_end_date",
        F.when(F.col("day_of_week") == week_start_day, F.date_add("date_day", 6)).alias("week_end"),
    )
    gap = F.abs(F.datediff("week_end", "month_end_date"))
    ranked = (
        closing.where("week_end is not null")
        .distinct()
        .withColumn("_r", F.rank().over(Window.partitionBy("fiscal_year_number").orderBy(gap)))
        .where("_r = 1")
    )
    # one row per fiscal year, so an unpartitioned window is bounded by the number of years
    by_end = Window.orderBy("week_end")
    years = ranked.select(
        "fiscal_year_number",
        F.date_add(F.lag("week_end").over(by_end), 1).alias("fiscal_year_start_date"),
        F.col("week_end").alias("fiscal_year_end_date"),
    ).where("fiscal_year_start_date is not null")
    back = (F.col("day_of_week") - week_start_day + 7) % 7
    days = dates.select("date_day", F.date_sub("date_day", back).alias("week_start_date"))
    # a day belongs to a listed week only when the week's first day is in the dimension
    starts = dates.where(F.col("day_of_week") == week_start_day).select(
        F.col("date_day").alias("week_start_date")
    )
    joined = days.join(starts, "week_start_date", "left_semi").join(
        F.broadcast(years),
        F.col("date_day").between(F.col("fiscal_year_start_date"), F.col("fiscal_year_end_date")),
    )
    week = F.dense_rank().over(Window.partitionBy("fiscal_year_number").orderBy("week_start_date"))
    return joined.select(
        "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date",
        "week_start_date", F.date_add("week_start_date", 6).alias("week_end_date"),
        week.alias("fiscal_week_of_year"),
    )


def fiscal_periods(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """4-5-4 retail calendar; a 53rd week joins the third period of the last quarter."""
    weeks = fiscal_year_dates(dates, year_end_month, week_start_day, shift_year)
    w = F.col("fiscal_week_of_year")
    in_quarter = (w - 1) % 13
    quarter = F.least(F.floor((w - 1) / 13), F.lit(3)).cast("int")
    period = (
        F.when(w == 53, 3).when(in_quarter <= 3, 1).when(in_quarter <= 8, 2).otherwise(3)
    )
    return weeks.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        (quarter * 3 + period).alias("fiscal_period_number"),
        (quarter + 1).alias("fiscal_quarter_number"),
        period.alias("fiscal_period_of_quarter"),
    ).withColumn(
        "fiscal_week_of_period",
        F.dense_rank().over(Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")),
    )
