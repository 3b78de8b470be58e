"""Day, second and settlement-calendar expressions (all UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400


def day_of(ts: Column) -> Column:
    """UTC day of a unix-second column."""
    return F.date_from_unix_date(F.floor(ts / F.lit(SECONDS_PER_DAY)).cast("int"))


def midnight(day: Column) -> Column:
    """Unix second at which a day starts."""
    return F.unix_date(day).cast("bigint") * F.lit(SECONDS_PER_DAY)


def next_midnight(day: Column) -> Column:
    return midnight(day) + F.lit(SECONDS_PER_DAY)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one timestamp to another."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_between(first: Column, last: Column) -> Column:
    """Array of days from first to last inclusive; empty when first > last."""
    empty = F.array().cast("array<date>")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))).otherwise(empty)


def settle_last_day(month: Column) -> Column:
    """Last day of the settlement month ``yyyy-MM``."""
    return F.last_day(F.to_date(F.concat(month, F.lit("-01"))))


def settle_end_exclusive(month: Column) -> Column:
    """First day after the settlement month ``yyyy-MM``."""
    return F.add_months(F.to_date(F.concat(month, F.lit("-01"))), 1)


def named_month(label: Column) -> Column:
    """``Jan 2026`` to the first day of that month, anything else to null."""
    text = F.trim(label)
    shaped = F.when(text.rlike(r"^(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{4}$"), text)
    return F.to_date(F.regexp_replace(shaped, r"\s+", " "), "MMM yyyy")
