"""Small column expressions shared by the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts accepted for text times, tried in this order.
TEXT_TIME_LAYOUTS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
]


def decimal_of(c: Column, scale: int, precision: int = 18) -> Column:
    """Text to decimal, NULL for text that is no number."""
    return c.try_cast(f"decimal({precision},{scale})")


def millis(c: Column) -> Column:
    """Cut a timestamp to milliseconds."""
    return F.date_trunc("millisecond", c)


def micros_to_ts(c: Column) -> Column:
    return millis(F.timestamp_micros(c))


def millis_to_ts(c: Column) -> Column:
    return F.timestamp_millis(c)


def best_effort_ts(c: Column, layouts: Sequence[str] = TEXT_TIME_LAYOUTS) -> Column:
    """First layout that reads the text; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in layouts], c.try_cast("timestamp"))


def int_or_zero(c: Column, kind: str = "bigint") -> Column:
    return F.coalesce(c.try_cast(kind), F.lit(0).cast(kind))


def epoch_days_to_date(c: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), c.cast("int"))


def text_or_days_to_date(c: Column) -> Column:
    """A date sent as ISO text or as a day number."""
    return F.when(c.rlike("^-?[0-9]+$"), epoch_days_to_date(c.try_cast("int"))).otherwise(c.try_cast("date"))


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def mask_field() -> Column:
    # Fixed value: the constant that replaces a masked field.
    return F.lit("********")


def mask_pii(c: Column) -> Column:
    """Upper-case hex SHA-256 of the text."""
    return F.upper(F.sha2(c.cast("string"), 256))


def clamp_far_future(ts: Column, as_of: Column) -> Column:
    """A time in a year beyond next year counts as now."""
    return F.when(F.year(ts) > F.year(as_of) + 1, as_of).otherwise(ts)


def share(cond: Column) -> Column:
    """Share of rows for which a condition holds, 0 for none."""
    return F.coalesce(F.try_divide(F.count_if(cond).cast("double"), F.count(F.lit(1))), F.lit(0.0))


def regexp_position(c: Column, pattern: str, position: int = 1, occurrence: int = 1, flags: str = "") -> Column:
    """1-based place of a match, 0 when there is none.

    A later match starts behind the texts between the matches and the matches before it; their lengths are added up, so
    line ends, flags and groups of the pattern change nothing. The pattern must not match the empty text.
    """
    regex = F.lit(f"(?{flags}){pattern}" if flags else pattern)
    tail = c if position == 1 else F.substring(c, position, 2_147_483_647)
    if occurrence == 1:
        found = F.regexp_instr(tail, regex)
        return F.when(found > 0, found + (position - 1)).otherwise(found)
    matches = F.regexp_extract_all(tail, regex, F.lit(0))
    between = F.split(tail, regex, -1)

    def lengths(parts: Column, n: int) -> Column:
        return F.aggregate(F.slice(parts, 1, n), F.lit(0), lambda total, part: total + F.char_length(part))

    start = lengths(between, occurrence) + lengths(matches, occurrence - 1) + F.lit(position)
    return F.when(F.size(matches) >= occurrence, start).when(c.isNotNull(), F.lit(0))
