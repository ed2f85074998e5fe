"""Mixed date and clock texts.

Texts are recognised by shape and brought to the order ``YYYY-MM-DD HH:MM:SS`` for a
single ``try_cast``, which decides whether that moment exists. The most frequent
layout is tested first and needs one pattern and the cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.fixed_values import CLOCK_FRAGMENT, DATE_FRAGMENT, NULL_TOKEN
from mendwork.functions.text import SPACES, ascii_digits, strip

# First year that a nanosecond timestamp covers in full, and the range's ends.
MIN_YEAR = 1678
FIRST_MOMENT = "1677-09-21 00:12:44"
LAST_MOMENT = "2262-04-11 23:47:16"

_CLOCK = "[0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2})?"
_DAY = "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_SLASHED = "([0-9]{4})/([0-9]{2})/([0-9]{2})"
_MERIDIEM = f"(?:{SPACES})?(?:am|pm){SPACES}{_SLASHED}"

# The layout that a cast reads as it stands (leap seconds aside).
DAY_FIRST = f"^{_DAY}(?: [0-9]{{1,2}}:[0-9]{{1,2}}(?::[0-5]?[0-9])?)?$"
ANY_DAY_FIRST = f"^{_DAY}(?: {_CLOCK})?$"

# Every other layout, and how it is put in that order.
REORDERED = (
    (f"^({_CLOCK}){SPACES}({_DAY})$", "$2 $1"),
    (f"^({_DAY}){SPACES}({_CLOCK})$", "$1 $2"),
    (f"^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})$", "$1-$2-$3"),
    (f"^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}}){SPACES}({_CLOCK})$", "$1-$2-$3 $4"),
    (
        f"^([0-9]{{1,2}})-([0-9]{{1,2}})-([0-9]{{4}}){SPACES}([0-9]{{1,2}})-([0-9]{{1,2}})$",
        "$3-$4-$5 $1:$2",
    ),
    (f"(?i)^(0?[1-9]|1[01]){_MERIDIEM}$", "$2-$3-$4 $1:00"),
    (f"(?i)^12{_MERIDIEM}$", "$1-$2-$3 0:00"),
)
AFTERNOON = "(?i)^[0-9]+[^0-9]*pm"

REAL_CLOCK = "^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"

STAMP_LAYOUT = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
CLOCK_DAY_LAYOUT = "^[0-9]{2}:[0-9]{2} [0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _year_cap(max_year: int | None) -> Column:
    return F.lit(max_year) if max_year is not None else F.year(F.current_date())


def day_first_text(text: Column, plain: Column) -> Column:
    """A stripped text with its parts in the order ``YYYY-MM-DD[ HH:MM[:SS]]``, or ``''``.

    ``plain`` tells that it is in that order already. Meridiem hours stay on the
    12-hour clock.
    """
    ordered = text
    for pattern, order in REORDERED:
        ordered = F.regexp_replace(ordered, pattern, order)
    return F.when(plain, text).otherwise(F.regexp_extract(ordered, ANY_DAY_FIRST, 0))


def _stamp(day_first: Column) -> Column:
    """Cast of a day-first text; leap seconds 60 and 61 roll over into the next minute."""
    shift = F.make_dt_interval(
        secs=F.when(day_first.rlike(":6[01]$"), 10).otherwise(0).cast("decimal(18,6)")
    )
    earlier = F.regexp_replace(day_first, ":6([01])$", ":5$1").try_cast("timestamp_ntz")
    return F.coalesce(day_first.try_cast("timestamp_ntz"), earlier + shift)


def _ordered_stamp(day_first: Column, text: Column, plain: Column) -> Column:
    """The same for a reordered text, whose original tells the hours after noon."""
    afternoon = F.make_dt_interval(hours=F.when(text.rlike(AFTERNOON), 12).otherwise(0))
    return F.when(plain, day_first.try_cast("timestamp_ntz")).otherwise(_stamp(day_first) + afternoon)


def _in_years(day_first: Column, max_year: int | None, min_year: int) -> Column:
    last = F.lpad(_year_cap(max_year).cast("string"), 4, "0")
    return F.left(day_first, F.lit(4)).between(F.lit(f"{min_year:04d}"), last)


def parse_mixed_datetime(
    text: Column, max_year: int | None = None, min_year: int = MIN_YEAR
) -> Column:
    """Mixed text to TIMESTAMP_NTZ, NULL where no layout gives a real moment.

    ``max_year`` defaults to the current year; pass it for repeatable results. For
    large tables prefer ``with_parsed_datetime``, whose generated code is smaller.
    """
    t = strip(text)
    plain = t.rlike(DAY_FIRST)
    ordered = day_first_text(t, plain)
    return F.when(_in_years(ordered, max_year, min_year), _ordered_stamp(ordered, t, plain))


def with_parsed_datetime(
    df: DataFrame,
    column: str,
    out: str,
    max_year: int | None = None,
    min_year: int = MIN_YEAR,
    stripped: bool = False,
) -> DataFrame:
    """The same in steps, each of which is evaluated once per row.

    As one expression the patterns would be repeated for every use of their result,
    and the method generated for the stage would be too long for the JIT compiler.
    """
    staged = df.withColumn("_text", F.col(column) if stripped else strip(F.col(column)))
    text, plain, ordered = F.col("_text"), F.col("_plain"), F.col("_ordered")
    staged = staged.withColumn("_plain", text.rlike(DAY_FIRST))
    staged = staged.withColumn("_ordered", day_first_text(text, plain))
    inside = _in_years(ordered, max_year, min_year)
    stamp = F.when(inside, _ordered_stamp(ordered, text, plain))
    return staged.withColumn(out, stamp).drop("_text", "_plain", "_ordered")


def parse_salvaged(text: Column) -> Column:
    """The moment of a text that the salvage has put together (``HH:MM YYYY-MM-DD``)."""
    swapped = F.concat_ws(" ", F.right(text, F.lit(10)), F.left(text, F.lit(5)))
    return F.when(text.rlike(CLOCK_DAY_LAYOUT), swapped.try_cast("timestamp_ntz"))


def first_valid_date(text: Column, max_year: int | None = None) -> Column:
    """First ``YYYY-MM-DD`` or ``YYYY/MM/DD`` inside the text that is a real date, as text."""
    cap = _year_cap(max_year)
    found = F.regexp_extract_all(
        F.translate(ascii_digits(text), "/", "-"), F.lit(DATE_FRAGMENT), F.lit(0)
    )
    real = F.filter(found, lambda day: F.year(day.try_cast("date")).between(F.lit(1), cap))
    return F.try_element_at(real, F.lit(1))


def first_valid_clock(text: Column) -> Column:
    """First ``H:MM[:SS]`` inside the text that is a real clock time, as ``HH:MM``."""
    found = F.regexp_extract_all(ascii_digits(text), F.lit(CLOCK_FRAGMENT), F.lit(0))
    clock = F.try_element_at(F.filter(found, lambda c: c.rlike(REAL_CLOCK)), F.lit(1))
    return F.substring(F.regexp_replace(clock, "^([0-9]):", "0$1:"), 1, 5)


def salvage_time_text(
    text: Column,
    max_year: int | None = None,
    min_year: int = MIN_YEAR,
    parsed: Column | None = None,
) -> Column:
    """Keep a text that parses; else keep what is usable of it and write NULL for the rest.

    Pass ``parsed`` if the text is already stripped and parsed.
    """
    t = strip(text) if parsed is None else text
    parsed = parse_mixed_datetime(t, max_year, min_year) if parsed is None else parsed
    day = first_valid_date(t, max_year)
    clock = first_valid_clock(t)
    null = F.lit(NULL_TOKEN)
    return (
        F.when(parsed.isNotNull(), t)
        .when(F.coalesce(t == "", F.lit(True)), null)
        .when(
            day.isNotNull() & clock.isNotNull(),
            F.when(F.left(day, F.lit(4)).try_cast("int") >= min_year, F.concat_ws(" ", clock, day))
            .otherwise(null),
        )
        .when(day.isNotNull(), F.concat_ws(" ", null, day))
        .when(clock.isNotNull(), F.concat_ws(" ", clock, null))
        .otherwise(null)
    )


def _storable(stamp: Column) -> Column:
    return F.coalesce(
        stamp.between(
            F.lit(FIRST_MOMENT).cast("timestamp_ntz"), F.lit(LAST_MOMENT).cast("timestamp_ntz")
        ),
        F.lit(False),
    )


def matched_time_layout(text: Column) -> Column:
    """Which of the two accepted layouts a real moment is written in."""
    t = strip(text)
    swapped = F.concat_ws(" ", F.right(t, F.lit(10)), F.left(t, F.lit(5)))
    return (
        F.when(t.rlike(STAMP_LAYOUT) & _storable(_stamp(t)), "YYYY-MM-DD HH:MM:SS")
        .when(t.rlike(CLOCK_DAY_LAYOUT) & _storable(_stamp(swapped)), "HH:MM YYYY-MM-DD")
        .otherwise("invalid_format")
    )


def datetime_status(text: Column) -> Column:
    """valid, impossible_date_or_time (right layout, no such moment), invalid, or NULL."""
    t = strip(text)
    return (
        F.when(F.coalesce(t == "", F.lit(True)), NULL_TOKEN)
        .when(matched_time_layout(text) != "invalid_format", "valid")
        .when(t.rlike(STAMP_LAYOUT) | t.rlike(CLOCK_DAY_LAYOUT), "impossible_date_or_time")
        .otherwise("invalid")
    )


def stamp_format_status(text: Column) -> Column:
    """valid only for a real moment written exactly ``YYYY-MM-DD HH:MM:SS``."""
    t = strip(text)
    good = t.rlike(STAMP_LAYOUT) & _storable(_stamp(t))
    return F.when(F.coalesce(good, F.lit(False)), "valid").otherwise("invalid")


def written_hour(text: Column) -> Column:
    """The hour as written in one of the two layouts, without a range check (25 stays 25)."""
    t = strip(text)
    clock_day = r"^([0-9]{2}):[0-9]{2}\s[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    day_clock = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\s([0-9]{2}):[0-9]{2}:[0-9]{2}$"
    hour = F.concat(F.regexp_extract(t, clock_day, 1), F.regexp_extract(t, day_clock, 1))
    return F.nullif(hour, F.lit("")).try_cast("int")


def iso_stamp(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")


def iso_day(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd")


def iso_clock(stamp: Column) -> Column:
    return F.date_format(stamp, "HH:mm:ss")
