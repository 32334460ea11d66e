"""Dates as sites type them. Unparseable and impossible dates give null; every "now" is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
FULL = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def _month(name: Column) -> Column:
    """The number of an English month by its name or first three letters (sept too); null for another word."""
    low = F.lower(name)
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(low, 1, 3))
    return F.when(low.isin(*MONTHS, *FULL, "sept"), at)


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%s-%02d-%02d", year, F.coalesce(month, F.lit(0)).cast("int"), day.try_cast("int")), "yyyy-MM-dd")


def rss_date(text: Column) -> Column:
    """The date in a feed's "Wed, 15 Jan 2026 10:00:00 GMT" and the like, as written, in no other time zone."""
    part = lambda i: F.regexp_extract(text, r"(?:^|\D)(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})", i)
    return F.when(part(1) != "", _date(part(3), _month(part(2)), part(1)))


def flexible_date(text: Column, year: int, pattern: str | None = None) -> Column:
    """A date by ``pattern`` (Spark's) if there is one, else by its first words and numbers: 2026-03-05 and whatever follows; a month's
    name and a day in either order, then a year; or just a month's name and a day, which are of ``year``."""
    t = F.trim(text)
    token = F.regexp_extract_all(t, F.lit(r"(\d+|[A-Za-z]+)"), F.lit(1))
    first, second, third = (F.get(token, F.lit(i)) for i in range(3))
    named = _month(first).isNotNull()
    in_year = F.when(third.rlike(r"^\d{4}"), F.left(third, F.lit(4))).when((F.size(token) == 2) & named, F.lit(f"{year:04d}"))
    typed = _date(in_year, F.coalesce(_month(first), _month(second)), F.when(named, second).otherwise(first))
    out = F.when(t.rlike(r"^\d{4}-\d\d-\d\d"), F.try_to_date(F.left(t, F.lit(10)), "yyyy-MM-dd")).otherwise(typed)
    return F.coalesce(F.try_to_date(t, pattern), out) if pattern else out


def month_year(text: Column) -> Column:
    """ISO, "March 5, 2026", "March 2026" and "Mar 2026"; the first of a month without a day."""
    part = lambda i: F.regexp_extract(F.trim(text), r"^([A-Za-z]+)\s+(\d{4})$", i)
    return F.coalesce(flexible_date(text, 1), F.when(part(1) != "", _date(part(2), _month(part(1)), F.lit("1"))))


def from_parts(parts: Column, today: Column, ahead: int = 7) -> Column:
    """A date from [year, month, day]; 1 for a missing month or day, ``today`` for none, an impossible one, or one over ``ahead`` days in the future."""
    get = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(1))
    made = F.try_to_date(F.format_string("%04d-%02d-%02d", F.get(parts, F.lit(0)).cast("int"), get(1).cast("int"), get(2).cast("int")), "yyyy-MM-dd")
    return F.when(made.isNull() | (made > F.date_add(today, ahead)), today).otherwise(made)


def without_future(date: Column, now: Column, days: int = 7) -> Column:
    """Null for a date more than ``days`` after ``now``."""
    return F.when(date.cast("timestamp") <= now + F.expr(f"interval {days} days"), date)


def last_boundary(now: Column, hour: int = 8) -> Column:
    """The last time it was ``hour`` o'clock: today, or yesterday before it."""
    today = F.date_trunc("day", now) + F.expr(f"interval {hour} hours")
    return F.when(now >= today, today).otherwise(today - F.expr("interval 1 day"))


def week_ending(date: Column) -> Column:
    """The Sunday on or after a date."""
    return F.next_day(F.date_sub(date, 1), "SUN")
