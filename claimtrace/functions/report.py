"""Money, ratio, bucket and text-format helpers of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO = "decimal(38,10)"


def sum_abs(c: Column) -> Column:
    """Sum of magnitudes; NULL over no rows."""
    return F.sum(F.abs(c))


def money(c: Column, places: int = 2) -> Column:
    """Amount rounded half up, NULL as 0."""
    return F.coalesce(F.round(c, places), F.lit(0))


def ratio(part: Column, total: Column, factor: int, places: int) -> Column:
    """``factor * part / total`` rounded half up; NULL when the total is 0 or NULL.

    Decimals keep the rounding exact.
    """
    scaled = (part * F.lit(factor)).cast("decimal(28,2)")
    bottom = F.nullif(total.cast("decimal(26,2)"), F.lit(0).cast("decimal(26,2)"))
    return F.round((scaled / bottom).cast(RATIO), places)


def percent(part: Column, total: Column, places: int = 0) -> Column:
    """Share of a total in percent."""
    return ratio(part, total, 100, places)


def bucket(unit: str, c: Column) -> Column:
    """Start of the hour, day, week (Monday) or month, without time zone."""
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def day(c: Column) -> Column:
    """Calendar day."""
    return F.to_date(c)


def grouped_number(c: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(c, 0)


def plain_number(c: Column, places: int = 0) -> Column:
    """Rounded number as text with a fixed count of decimals."""
    return c.cast(f"decimal(28,{places})").cast("string")


def day_text(c: Column) -> Column:
    """``May 01, 2025``."""
    return F.date_format(c, "MMM dd, yyyy")


def minute_text(c: Column) -> Column:
    """``May 01, 2025 01:05``, twelve-hour clock without the half of the day."""
    return F.date_format(c, "MMM dd, yyyy hh:mm")


def minute_text_half(c: Column) -> Column:
    """``May 01, 2025 01:05 PM``."""
    return F.date_format(c, "MMM dd, yyyy hh:mm a")


def month_text(c: Column) -> Column:
    """``May 2025``."""
    return F.date_format(c, "MMMM yyyy")


def dash(c: Column) -> Column:
    """NULL shown as a dash."""
    return F.coalesce(c, F.lit("-"))


def customer_name(ship_to: Column, address: Column) -> Column:
    """Ship-to name, else address name, else Unknown."""
    return F.coalesce(ship_to, address, F.lit("Unknown"))


def contains_text(c: Column, part: str) -> Column:
    """Case-insensitive LIKE; ``%`` and ``_`` in ``part`` stay wildcards."""
    return c.ilike(f"%{part}%")


def suffix_equals(value: Column, suffix: Column, length: int) -> Column:
    """``suffix`` has ``length`` characters and ends ``value``."""
    return (F.length(suffix) == length) & (F.right(value, F.lit(length)) == suffix)
