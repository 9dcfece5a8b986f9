"""Calendar columns. Weeks start on Sunday unless a name says ISO."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_part(part: str, c: Column) -> Column:
    return F.date_part(F.lit(part), c)


def day_name(c: Column, short: bool = True) -> Column:
    return F.date_format(c, "E" if short else "EEEE")


def month_name(c: Column, short: bool = True) -> Column:
    return F.date_format(c, "MMM" if short else "MMMM")


def day_of_week(c: Column, isoweek: bool = True) -> Column:
    return F.weekday(c) + 1 if isoweek else F.dayofweek(c)


def iso_week_start(c: Column) -> Column:
    return F.to_date(F.date_trunc("week", c))


def iso_week_end(c: Column) -> Column:
    return F.date_add(iso_week_start(c), 6)


def iso_week_of_year(c: Column) -> Column:
    return F.weekofyear(c)


def week_start(c: Column) -> Column:
    return F.date_sub(F.to_date(c), F.dayofweek(c) - 1)


def week_end(c: Column) -> Column:
    return F.date_add(week_start(c), 6)


def week_of_year(c: Column) -> Column:
    return F.ceil(F.dayofyear(c) / 7).cast("int")


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def quarter_start(c: Column) -> Column:
    return F.trunc(c, "quarter")


def quarter_end(c: Column) -> Column:
    return F.last_day(F.add_months(quarter_start(c), 2))


def year_start(c: Column) -> Column:
    return F.trunc(c, "year")


def year_end(c: Column) -> Column:
    return F.last_day(F.add_months(year_start(c), 11))


def n_days_ago(n: int, c: Column) -> Column:
    return F.date_sub(F.to_date(c), n)


def n_days_away(n: int, c: Column) -> Column:
    return F.date_add(F.to_date(c), n)


def n_weeks_ago(n: int, c: Column) -> Column:
    return F.date_sub(iso_week_start(c), 7 * n)


def n_weeks_away(n: int, c: Column) -> Column:
    return F.date_add(iso_week_start(c), 7 * n)


def n_months_ago(n: int, c: Column) -> Column:
    return month_start(F.add_months(F.to_date(c), -n))


def n_months_away(n: int, c: Column) -> Column:
    return month_start(F.add_months(F.to_date(c), n))


def last_week(c: Column) -> Column:
    return n_weeks_ago(1, c)


def next_week(c: Column) -> Column:
    return n_weeks_away(1, c)


def last_month(c: Column) -> Column:
    return n_months_ago(1, c)


def next_month(c: Column) -> Column:
    return n_months_away(1, c)


def last_month_name(c: Column, short: bool = True) -> Column:
    return month_name(last_month(c), short)


def next_month_name(c: Column, short: bool = True) -> Column:
    return month_name(next_month(c), short)


def last_month_number(c: Column) -> Column:
    return F.month(last_month(c))


def next_month_number(c: Column) -> Column:
    return F.month(next_month(c))


def yesterday(c: Column) -> Column:
    return n_days_ago(1, c)


def tomorrow(c: Column) -> Column:
    return n_days_away(1, c)


def now(tz: str = "UTC", as_of: Column | None = None) -> Column:
    """Wall time in ``tz``; ``as_of`` is a UTC timestamp without zone."""
    base = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    return convert_timezone(base, tz)


def today(tz: str = "UTC", as_of: Column | None = None) -> Column:
    return F.to_date(now(tz, as_of))


def convert_timezone(c: Column, target: str, source: str = "UTC") -> Column:
    return F.convert_timezone(F.lit(source), F.lit(target), c.cast("timestamp_ntz"))


def from_unixtimestamp(c: Column, fmt: str = "seconds") -> Column:
    build = {
        "seconds": F.timestamp_seconds,
        "milliseconds": F.timestamp_millis,
        "microseconds": F.timestamp_micros,
    }[fmt]
    return build(c)


def to_unixtimestamp(c: Column) -> Column:
    return F.unix_seconds(c.cast("timestamp"))


def date_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries between two times (not elapsed whole units)."""
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "quarter":
        return (F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)
    if unit == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    if unit == "day":
        return F.datediff(F.to_date(end), F.to_date(start))
    if unit == "week":
        return (F.datediff(iso_week_start(end), iso_week_start(start)) / 7).cast("int")
    seconds = {"hour": 3600, "minute": 60, "second": 1}[unit]

    def ticks(c: Column) -> Column:
        return F.floor(F.unix_seconds(c.cast("timestamp")) / seconds)

    return ticks(end) - ticks(start)


def periods_since(c: Column, as_of: Column, period: str = "day") -> Column:
    return date_diff(period, c, as_of)


def round_timestamp(c: Column) -> Column:
    """Nearest midnight."""
    return F.date_trunc("day", c + F.expr("interval 12 hours"))
