"""Date parsing and ages; every "now" is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Layouts that are tried in order (fixed values).
LAYOUTS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd MMM yyyy", "MMM dd, yyyy",
]

_UNITS = {"hour": 1, "day": 24, "week": 24 * 7, "month": 24 * 30}


def parse_lenient(c: Column) -> Column:
    """Timestamp of a date string in any known layout; null if it is none."""
    text = F.trim(c.cast("string"))
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp")),
        *[F.try_to_timestamp(text, F.lit(layout)) for layout in LAYOUTS],
    )


def age_in_days(as_of: Column, published: Column) -> Column:
    """Whole days between, rounded down (half a day ahead is -1)."""
    seconds = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(published.cast("timestamp"))
    return F.floor(seconds / F.lit(86_400_000_000)).cast("int")


def resolve_relative_date(phrase: Column, as_of: Column) -> Column:
    """Date meant by "3 days ago" or "recently"; other text is parsed as a date."""
    pattern = r"(?i)(\d+).*?(hour|day|week|month)"
    unit = F.lower(F.regexp_extract(phrase, pattern, 2))
    count = F.regexp_extract(phrase, pattern, 1).try_cast("int")
    hours = F.lit(0)
    for name, size in _UNITS.items():
        hours = F.when(unit == name, count * size).otherwise(hours)
    back = as_of.cast("timestamp") - F.make_dt_interval(hours=hours)
    return (
        F.when(phrase.rlike(r"(?i)ago\s*$") & phrase.rlike(pattern), back.cast("date"))
        .when(F.lower(phrase).isin("recently", "today/recently"), as_of.cast("date"))
        .otherwise(parse_lenient(phrase).cast("date"))
    )
