"""Date parsing and the month text used by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "iso"
ZONED = "yyyy-M-d'T'H:mm:ssXXX"

# First and last whole day of a 64-bit nanosecond clock.
FIRST_DATE = "1677-09-22"
LAST_DATE = "2262-04-11"

# Layouts tried, in order, on the first date of a source.  Month comes before day where both fit.
DATE_LAYOUTS = [
    ISO_DATE,
    "yyyy-M-d H:mm:ss",
    "yyyy-M-d'T'H:mm:ss",
    "yyyy-M-d H:mm",
    "yyyy-M-d'T'H:mm",
    "yyyy-M-d H:mm:ss.SSSSSSSSS",
    "yyyy-M-d'T'H:mm:ss.SSSSSSSSS",
    ZONED,
    "yyyy/M/d",
    "yyyy/M/d H:mm:ss",
    "yyyyMMdd",
    "M/d/yyyy",
    "d/M/yyyy",
    "M/d/yyyy H:mm:ss",
    "d/M/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "d/M/yyyy H:mm",
    "M-d-yyyy",
    "d-M-yyyy",
    "M.d.yyyy",
    "d.M.yyyy",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
]

_ISO_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _parse_one(text: Column, layout: str) -> Column:
    if layout == ISO_DATE:
        return F.when(text.rlike(_ISO_TEXT), text.try_cast("date"))
    if layout == ZONED:
        # The date as written, not as seen from the session's time zone.
        written = F.substring_index(text, "T", 1).try_cast("date")
        return F.when(F.try_to_timestamp(text, F.lit(layout)).isNotNull(), written)
    return F.try_to_timestamp(text, F.lit(layout)).cast("date")


def parse_date(text: Column, layouts: Sequence[str] = (ISO_DATE,)) -> Column:
    """The date in a text by the first layout that fits, null when none does.  The time of day is dropped."""
    parsed = [_parse_one(text, layout) for layout in layouts]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def in_range(date: Column) -> Column:
    """True for a date a 64-bit nanosecond clock holds; others count as unreadable."""
    return date.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date"))


def pick_date_formats(first_value: Column) -> Column:
    """Name of the layout that reads one sample date, null when none does."""
    return F.coalesce(
        *[F.when(_parse_one(first_value, layout).isNotNull(), F.lit(layout)) for layout in DATE_LAYOUTS]
    )


def period_of(year: Column, month: Column) -> Column:
    """``2024-03`` from a year and a month number."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
