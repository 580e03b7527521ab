"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast alone would also take Java notations such as ``12d`` or ``0x1p3``.
_NUMBER_TEXT = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def parse_number(text: Column, on_bad: str = "fail") -> Column:
    """Read a text as a double.

    ``on_bad="fail"`` raises on a text that is no number, ``"null"`` makes it null.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    value = F.when(text.rlike(_NUMBER_TEXT), text.try_cast("double"))
    if on_bad == "null":
        return value
    return value.when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a number: "), text)))


def round2(value: Column) -> Column:
    """Round a double to two places the way array libraries do: scale by 100, half to even, unscale."""
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)
