"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space when the ends of a text are stripped.
WHITE_SPACE = "".join(
    chr(code)
    for code in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)

_VISIBLE_ENDS = r"^[!-~](?:.*[!-~])?\z"
_PLAIN_WORDS = r"^[A-Za-z ]*$"
_AFTER_UNCASED = r"(?<=[^\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}])"


def strip_space(col: Column) -> Column:
    """Remove leading and trailing white space of any kind, not just blanks.

    Stripping a set of characters is several times slower than stripping blanks, so it is left for
    texts that do not begin and end in visible ASCII once the blanks are gone.
    """
    no_blanks = F.trim(col)
    return F.when(no_blanks.rlike(_VISIBLE_ENDS), no_blanks).otherwise(F.trim(no_blanks, F.lit(WHITE_SPACE)))


def blank_to_null(col: Column) -> Column:
    """Strip, then treat an empty text and the exact text ``nan`` as no value.

    One test for both: where a filter on the result is moved into a join, each mention of the text strips it again.
    """
    stripped = strip_space(col.cast("string"))
    return F.when(~stripped.isin("", "nan"), stripped)


def title_case(col: Column) -> Column:
    """Upper-case each letter that does not follow a letter and lower-case the rest (``O'Neil-Smith``).

    ``initcap`` only starts a word after a blank.  It is enough, and stays in generated code, for
    texts of ASCII letters and blanks; other texts are cut after every uncased character first.
    """
    pieces = F.split(F.lower(col), _AFTER_UNCASED)
    general = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(col.rlike(_PLAIN_WORDS), F.initcap(col)).otherwise(general)


def display_label(name: str) -> str:
    """Report heading of a column name: ``total_revenue`` becomes ``Total Revenue``."""
    return " ".join(word.capitalize() for word in name.split("_"))
