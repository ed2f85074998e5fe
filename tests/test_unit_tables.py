"""Parser, salvage, numbers and null policies on single values."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from mendwork.functions import datetimes, formats, numeric
from mendwork.functions.fixed_values import SPACE_CHARS
from mendwork.functions.nulls import NullPolicy, is_missing, is_null_like
from mendwork.functions.text import snake_case, strip

# text -> parsed moment, salvaged text ("same" keeps it); max_year 2026
TIMES = [
    ("2025-09-08 23:17:00", "2025-09-08 23:17:00", "same"),
    ("07:32 2025-09-20", "2025-09-20 07:32:00", "same"),
    ("03-00-2025 09-11", "2025-09-11 03:00:00", "same"),
    ("3pm 2025/09/11", "2025-09-11 15:00:00", "same"),
    ("3 PM 2025/09/11", "2025-09-11 15:00:00", "same"),
    ("11am 2025/09/11", "2025-09-11 11:00:00", "same"),
    ("12am 2025/09/11", "2025-09-11 00:00:00", "same"),
    ("12pm 2025/09/11", "2025-09-11 12:00:00", "same"),
    ("13pm 2025/09/11", None, "NULL 2025-09-11"),
    ("0pm 2025/09/11", None, "NULL 2025-09-11"),
    ("25:61 2025-09-11", None, "NULL 2025-09-11"),
    ("99:99 2025-13-40", None, "NULL"),
    ("12:00", None, "12:00 NULL"),
    ("10:00 2025-02-30", None, "10:00 NULL"),
    ("2025-09-11, 10:00:30", None, "10:00 2025-09-11"),
    ("10:00 2025/09/11", None, "10:00 2025-09-11"),
    ("2099-01-01 00:00:00", None, "00:00 NULL"),
    ("2025-9-1", "2025-09-01 00:00:00", "same"),
    ("2025/9/1 1:2", "2025-09-01 01:02:00", "same"),
    ("2025-09-11\t10:00:00", "2025-09-11 10:00:00", "same"),
    ("1:2:3 2025-9-1", "2025-09-01 01:02:03", "same"),
    ("2024-02-29", "2024-02-29 00:00:00", "same"),
    ("2025-02-29", None, "NULL"),
    ("99:99 x 07:32", None, "07:32 NULL"),
    ("99:99:07:32", None, "NULL"),
    ("2025-13-40 2025-09-11", None, "NULL 2025-09-11"),
    ("2025-09-11T10:00:00", None, "00:00 NULL"),
    ("2025-09-11 10:00:00.5", None, "10:00 2025-09-11"),
    ("2025-09-11 24:00:00", None, "NULL 2025-09-11"),
    ("2025-09-11 10:00:60", "2025-09-11 10:01:00", "same"),
    ("10:00:61 2025-09-11", "2025-09-11 10:01:01", "same"),
    ("1600-01-01", None, "NULL 1600-01-01"),
    ("10:00 1600-01-01", None, "NULL"),
    ("۱۲:۳۰", None, "12:30 NULL"),
    ("free text", None, "NULL"),
    ("", None, "NULL"),
    (" \t", None, "NULL"),
    (None, None, "NULL"),
]


def test_parse_and_salvage(spark):
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TIMES)], "i int, t string")
    staged = datetimes.with_parsed_datetime(df, "t", "staged", 2026)
    rows = staged.select(
        "i",
        "staged",
        datetimes.parse_mixed_datetime(F.col("t"), 2026).alias("parsed"),
        datetimes.salvage_time_text(F.col("t"), 2026).alias("text"),
    ).collect()
    for row in rows:
        text, parsed, salvaged = TIMES[row.i]
        want = datetime.datetime.fromisoformat(parsed) if parsed else None
        assert row.parsed == want, text
        assert row.staged == want, text
        assert row.text == (text if salvaged == "same" else salvaged), text


def test_default_year_cap_is_the_current_year(spark):
    df = spark.range(1).select(
        F.concat((F.year(F.current_date()) + F.col("id").cast("int")).cast("string"), F.lit("-01-01")).alias("now"),
        F.concat((F.year(F.current_date()) + 1).cast("string"), F.lit("-01-01")).alias("next"),
    )
    row = df.select(
        datetimes.parse_mixed_datetime(F.col("now")).alias("now"),
        datetimes.parse_mixed_datetime(F.col("next")).alias("next"),
    ).first()
    assert row.now is not None and row.next is None


@pytest.mark.parametrize(
    "text, status, layout, hour",
    [
        ("2025-09-11 10:00:00", "valid", "YYYY-MM-DD HH:MM:SS", 10),
        (" 07:32 2025-09-20 ", "valid", "HH:MM YYYY-MM-DD", 7),
        ("25:61 2025-09-11", "impossible_date_or_time", "invalid_format", 25),
        ("2030-13-33 10:00:00", "impossible_date_or_time", "invalid_format", 10),
        ("7:32 2025-09-20", "invalid", "invalid_format", None),
        ("3pm 2025/09/11", "invalid", "invalid_format", None),
        ("2099-01-01 00:00:00", "valid", "YYYY-MM-DD HH:MM:SS", 0),
        ("", "NULL", "invalid_format", None),
        (None, "NULL", "invalid_format", None),
    ],
)
def test_two_layout_check(spark, text, status, layout, hour):
    t = F.col("t")
    row = spark.createDataFrame([(text,)], "t string").select(
        datetimes.datetime_status(t), datetimes.matched_time_layout(t), datetimes.written_hour(t)
    ).first()
    assert tuple(row) == (status, layout, hour)


NUMBERS = [
    ("1e5", 100000.0), (" 12 ", 12.0), ("+5", 5.0), (".5", 0.5), ("5.", 5.0), ("-5000", -5000.0),
    ("100d", None), ("1f", None), ("nan", None), ("1,000", None), ("0x10", None), ("1_000", None),
    ("True", None), ("NULL", None), ("one hundred", 100.0), ("One Hundred", 100.0), ("1e999", None),
    ("1e-400", 0.0), ("", None), (None, None), ("--5", None), ("1e", None), ("12345678.91", 12345678.91),
]


def test_numbers(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NUMBERS)], "i int, t string")
    for row in df.select("i", numeric.to_number(F.col("t")).alias("x")).collect():
        assert row.x == NUMBERS[row.i][1], NUMBERS[row.i][0]


def test_number_texts(spark):
    df = spark.createDataFrame([(12345678.91, "54.0"), (100.0, "abc"), (0.5, " 7 ")], "x double, t string")
    rows = df.select(numeric.float_text(F.col("x")), numeric.whole_text(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("12345678.91", "54"), ("100.0", "abc"), ("0.5", "7")]


def test_strip_takes_all_unicode_white_space(spark):
    assert len(set(SPACE_CHARS)) == 29 and all(c.isspace() for c in SPACE_CHARS)
    df = spark.createDataFrame([(SPACE_CHARS + "a b" + SPACE_CHARS,), (SPACE_CHARS,)], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == ["a b", ""]


def test_null_policies(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("null",), ("NULL",), ("N/A",), ("x",)], "t string")
    counts = {p: df.filter(is_missing(df, "t", p)).count() for p in NullPolicy}
    assert counts == {
        NullPolicy.STRICT: 1, NullPolicy.NA_TOKENS: 5, NullPolicy.BLANK: 3, NullPolicy.NULL_LIKE: 5,
    }
    assert df.filter(is_null_like(F.col("t"))).count() == 5


@pytest.mark.parametrize(
    "text, name",
    [
        ("2025/09/11 10:00", "YYYY/MM/DD HH:MM"), ("2025/09/11 1:00:00", "YYYY/MM/DD HH:MM:SS"),
        ("2025-09-11", "YYYY-MM-DD only"), ("2025/09/11", "YYYY/MM/DD only"), ("9:00:01", "HH:MM:SS only"),
        ("null 2025-09-11", "NULL YYYY-MM-DD"), ("12:00 null", "HH:MM NULL"), (" null ", "NULL/empty"),
        ("3pm 2025/09/11", "OTHER"), (None, "NULL/empty"),
    ],
)
def test_time_classes(spark, text, name):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(formats.classify_time(F.col("t"))).first()[0] == name


@pytest.mark.parametrize(
    "text, name",
    [("12", "integer"), ("-1.5", "decimal"), ("1,234,567.8", "comma-number"), ("1e5", "text/other"), ("NULL", "NULL/empty")],
)
def test_amount_classes(spark, text, name):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(formats.classify_amount(F.col("t"))).first()[0] == name


def test_snake_case():
    names = ["Discount Applied", "Price Per Unit", "transactionDate", " BMI ", "Retail-Price ($)"]
    assert [snake_case(n) for n in names] == [
        "discount_applied", "price_per_unit", "transaction_date", "bmi", "retail_price",
    ]
