"""Numbers from text, and small numeric rules."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from mendwork.functions.fixed_values import FALSE_TEXTS, NUMBER_WORDS, TRUE_TEXTS
from mendwork.functions.text import strip

# The whole text must be a decimal number: a bare cast also takes 100d, 1f and nan.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def replace_words(text: Column, words: Mapping[str, str] = NUMBER_WORDS) -> Column:
    """Amounts written as words, in any case, become digits."""
    for word, digits in words.items():
        text = F.regexp_replace(text, f"(?i)^{re.escape(word)}$", digits)
    return text


def to_number(
    text: Column, words: Mapping[str, str] | None = NUMBER_WORDS, stripped: bool = False
) -> Column:
    """Text to double; NULL for whatever is not a decimal number or beyond what a double can hold.

    Mentions its input once, so that nested uses (filters that Catalyst pushes through
    projections) stay small.
    """
    trimmed = text if stripped else strip(text)
    if words:
        trimmed = replace_words(trimmed, words)
    number = F.regexp_extract(trimmed, NUMBER_PATTERN, 0).try_cast("double")
    # The remainder by infinity is the number itself, and NaN for an infinite one.
    return F.nanvl(number % float("inf"), F.lit(None).cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, 0.0 for an empty whole."""
    return F.coalesce(F.round(F.try_divide(part, whole) * 100, digits), F.lit(0.0))


def fraction_to_percent(x: Column) -> Column:
    return x * 100


def rescale_above(x: Column, limit: float = 1.0, divisor: float = 10.0) -> Column:
    """Values above ``limit`` were recorded on a larger scale: divide them."""
    return F.when(x > limit, x / divisor).otherwise(x)


def round_to_step(x: Column, step: float = 1.0) -> Column:
    """Nearest multiple of ``step`` (halves away from zero)."""
    return F.round(x / F.lit(float(step))) * F.lit(float(step))


def to_boolean(text: Column) -> Column:
    """True, false, or NULL for unknown: an unknown is never taken as false."""
    key = F.lower(strip(text.cast("string")))
    return F.when(key.isin(*TRUE_TEXTS), F.lit(True)).when(key.isin(*FALSE_TEXTS), F.lit(False))


def float_text(x: Column) -> Column:
    """A double as plain text, ``100.0`` rather than ``1.0E2``, as in a CSV file."""
    plain = x.cast("string")
    digits = F.rtrim(plain.try_cast("decimal(38,22)").cast("string"), F.lit("0"))
    spelled = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    readable = (F.abs(x) >= 1e-4) & (F.abs(x) < 1e16)
    return F.when(plain.contains("E") & readable, spelled).otherwise(plain)


def whole_text(x: Column) -> Column:
    """Number-like text without a zero fraction (``54.0`` -> ``54``), other text as is."""
    number = to_number(x.cast("string"), None)
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 9e18), number.cast("long"))
    return F.coalesce(whole.cast("string"), x.cast("string"))
