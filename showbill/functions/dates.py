"""Date expressions. Every predicate on today takes the date as a parameter; none reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from showbill.functions.text import clean_text, col, let


def parse_date(c: Column | str) -> Column:
    """The first year-month-day in the text, slashes allowed; null if there is none or it isn't a date."""
    found = F.regexp_extract(F.replace(clean_text(c), F.lit("/"), F.lit("-")), r"(\d{4}-\d{1,2}-\d{1,2})", 1)
    return let(found, lambda x: F.try_to_date(F.when(x != "", x), "yyyy-M-d"))


def date_or_text(c: Column | str) -> Column:
    return let(col(c), lambda x: F.coalesce(F.date_format(parse_date(x), "yyyy-MM-dd"), clean_text(x)))


def parse_moment(c: Column | str) -> Column:
    """A date with its time as a timestamp, as the app reads it: slashes allowed, a time may be glued to the day; null for anything else."""
    t = F.regexp_replace(F.replace(F.trim(col(c)), F.lit("/"), F.lit("-")), r"^(\d{4}-\d{2}-\d{2})[ T]?(\d{2}:)", "$1 $2")
    shapes = ("yyyy-M-d HH:mm:ss", "yyyy-M-d HH:mm", "yyyy-M-d")
    return let(t, lambda x: F.coalesce(*[F.try_to_timestamp(x, F.lit(s)) for s in shapes]))


def is_ongoing(start: Column | str, end: Column | str, today: Column) -> Column:
    """Open at either side where a date is missing."""
    return F.coalesce(col(start) <= today, F.lit(True)) & F.coalesce(col(end) >= today, F.lit(True))


def is_upcoming(start: Column | str, today: Column) -> Column:
    return F.coalesce(col(start) > today, F.lit(False))


def is_ending(start: Column | str, end: Column | str, today: Column, days: int = 14) -> Column:
    return is_ongoing(start, end, today) & F.coalesce(F.datediff(col(end), today).between(0, days), F.lit(False))


def occurs_on(start: Column | str, end: Column | str, day: Column) -> Column:
    """Within the interval; a missing end means a single day, and nothing occurs without a start and end."""
    first, last = F.coalesce(col(start), col(end)), F.coalesce(col(end), col(start))
    return F.coalesce((first <= day) & (last >= day), F.lit(False))


def recently(first_seen: Column | str, today: Column, days: int = 7) -> Column:
    return F.coalesce(F.datediff(today, col(first_seen)).between(0, days), F.lit(False))


def still_relevant(start: Column | str, end: Column | str, today: Column, past: int = 7, ahead: int = 550) -> Column:
    """Neither over for `past` days nor starting beyond `ahead` days; unknown dates pass."""
    last = F.coalesce(col(end), col(start))
    return F.coalesce(last >= F.date_sub(today, past), F.lit(True)) & F.coalesce(col(start) <= F.date_add(today, ahead), F.lit(True))


def date_range(start: Column | str, end: Column | str) -> Column:
    """Dates as yyyy.MM.dd, joined by an en dash if they differ."""
    a, b = F.date_format(col(start), "yyyy.MM.dd"), F.date_format(col(end), "yyyy.MM.dd")
    return F.when(a.eqNullSafe(b), a).otherwise(F.concat_ws(" – ", a, b))
