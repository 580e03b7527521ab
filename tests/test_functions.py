from __future__ import annotations

import random
import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ordermill.functions import (
    ISO_DATE,
    blank_to_null,
    display_label,
    parse_date,
    parse_number,
    period_of,
    pick_date_formats,
    round2,
    strip_space,
    title_case,
)
from ordermill.functions.text import WHITE_SPACE


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_strip_removes_every_kind_of_space(spark):
    every = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert sorted(WHITE_SPACE) == every
    values = [f"{s}a{s}b{s}{s}" for s in every] + [f"a{s}" for s in every] + ["", "   ", "x", "a\nb", None]
    assert apply(spark, strip_space, values) == [v if v is None else v.strip() for v in values]


def test_blank_and_nan_text_are_no_value(spark):
    values = ["", " \t", "nan", " nan ", "NaN", "None", "a", None]
    assert apply(spark, blank_to_null, values) == [None, None, None, None, "NaN", "None", "a", None]


@pytest.mark.parametrize("alphabet", ["abcXYZ '-.1 ", "abcDEF ", "aéÉößÄ -'9", "жЖαΑ b."])
def test_title_case_follows_the_python_rule(spark, alphabet):
    rng = random.Random(7)
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(300)]
    values += ["o'neil-smith", "NORTH east", "a1b", "3rd"]
    if "ß" in alphabet:  # a word starting with a letter whose title form has two letters
        values = [v for v in values if "ß" not in v]
    assert apply(spark, title_case, values) == [v.title() for v in values]


def test_iso_dates_match_pandas(spark):
    values = ["2024-01-15", "2024-1-5", "2024-02-30", " 2024-01-15", "2024-01", "15/02/2024", "20240115", "", "x", None]
    expected = pd.to_datetime(pd.Series(values), errors="coerce", format="%Y-%m-%d")
    assert apply(spark, parse_date, values) == [None if pd.isna(d) else d.date() for d in expected]


def test_layout_of_the_first_date(spark):
    values = [
        "2024-01-15",
        "01/15/2024",
        "15/02/2024",
        "01/02/2024",
        "2024/01/15",
        "20240115",
        "15-Jan-2024",
        "Jan 5, 2024",
        "January 5, 2024",
        "5 January 2024",
        "2024-01-15 10:00:00",
        "2024-01-15T10:00:00",
        "2024-01-15 10:00:00.123",
        "2024-01-15 10:00",
        "15.02.2024",
        "not a date",
    ]
    layouts = apply(spark, pick_date_formats, values)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        expected = [pd.to_datetime(v, errors="coerce") for v in values]
    assert layouts[0] == ISO_DATE and layouts[-1] is None
    for value, layout, date in zip(values[:-1], layouts[:-1], expected):
        assert layout is not None, value
        assert apply(spark, lambda c, used=layout: parse_date(c, [used]), [value]) == [date.date()], value


def test_zoned_date_is_the_date_as_written(spark):
    value = "2024-01-15T23:30:00-05:00"
    layout = apply(spark, pick_date_formats, [value])
    assert str(apply(spark, lambda c: parse_date(c, layout), [value])[0]) == "2024-01-15"


def test_numbers(spark):
    values = ["3", " 2.5 ", "-1e2", "+.5", "5.", "abc", "12d", "0x1p3", "1,5", None]
    expected = [3.0, 2.5, -100.0, 0.5, 5.0, None, None, None, None, None]
    assert apply(spark, lambda c: parse_number(c, "null"), values) == expected
    with pytest.raises(PySparkException, match="not a number"):
        apply(spark, lambda c: parse_number(c, "fail"), ["1", "abc"])
    with pytest.raises(ValueError):
        parse_number(F.col("v"), "ignore")


def test_round2_matches_numpy(spark):
    rng = random.Random(3)
    values = [rng.randint(1, 50) * rng.randint(0, 99999) / 100 * (1 - rng.randint(0, 100) / 100) for _ in range(5000)]
    values += [0.125, 0.135, 2.675, -0.125, 1e9 + 0.005]
    assert apply(spark, round2, values, "double") == [float(x) for x in np.round(values, 2)]


def test_period_and_label(spark):
    assert spark.range(1).select(period_of(F.lit(2024), F.lit(3))).first()[0] == "2024-03"
    assert display_label("avg_order_value") == "Avg Order Value"
