"""Column expressions.  All are built-in JVM expressions; none is a Python UDF."""

from ordermill.functions.dates import ISO_DATE, in_range, parse_date, period_of, pick_date_formats
from ordermill.functions.numbers import parse_number, round2
from ordermill.functions.text import blank_to_null, display_label, strip_space, title_case

__all__ = [
    "ISO_DATE",
    "blank_to_null",
    "display_label",
    "in_range",
    "parse_date",
    "parse_number",
    "period_of",
    "pick_date_formats",
    "round2",
    "strip_space",
    "title_case",
]
