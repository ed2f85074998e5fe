"""Format classes: which layout a text is written in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from mendwork.functions.fixed_values import (
    AMOUNT_LAYOUTS,
    CLOCK_LAYOUTS,
    DATE_LAYOUTS,
    TIME_LAYOUTS,
)
from mendwork.functions.nulls import is_null_like
from mendwork.functions.numeric import to_number
from mendwork.functions.text import SPACES, strip

Layouts = Sequence[tuple[str, str]]


def _padded(pattern: str) -> str:
    """The anchored pattern, in any case and with white space around it: so the text
    need not be trimmed again for every layout that is tried."""
    core = pattern.removeprefix("^").removesuffix("$")
    return f"(?i)^(?:{SPACES}+)?(?:{core})(?:{SPACES})?\\z"


def classify(text: Column, layouts: Layouts, other: str = "OTHER") -> Column:
    """Name of the first layout that matches; ``NULL/empty`` for null-like texts."""
    result = F.when(is_null_like(text), F.lit("NULL/empty"))
    for name, pattern in layouts:
        result = result.when(text.rlike(_padded(pattern)), F.lit(name))
    return result.otherwise(F.lit(other))


def classify_time(text: Column) -> Column:
    return classify(text, TIME_LAYOUTS)


def classify_date(text: Column) -> Column:
    return classify(text, DATE_LAYOUTS)


def classify_clock(text: Column) -> Column:
    return classify(text, CLOCK_LAYOUTS)


def classify_amount(text: Column) -> Column:
    return classify(text, AMOUNT_LAYOUTS, "text/other")


def number_kind(text: Column) -> Column:
    """integer, decimal, non_numeric or NULL, without replacing number words."""
    t = strip(text)
    return kind_of(t, to_number(t, None, stripped=True))


def kind_of(stripped: Column, number: Column) -> Column:
    """The same from the stripped text and its number."""
    return (
        F.when(F.coalesce(stripped == "", F.lit(True)), "NULL")
        .when(number.isNull(), "non_numeric")
        .when(number % 1 == 0, "integer")
        .otherwise("decimal")
    )
