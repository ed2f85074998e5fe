"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from mendwork.functions.fixed_values import ASCII_DIGITS, LOCAL_DIGITS, SPACE_CHARS

# One or more white space characters, for use inside larger patterns.
SPACES = "[" + SPACE_CHARS + "]+"


def strip(text: Column) -> Column:
    """Trim all Unicode white space (plain ``trim`` only removes blanks)."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def ascii_digits(text: Column) -> Column:
    """Replace Arabic-Indic and Persian digits by ASCII ones."""
    return F.translate(text, LOCAL_DIGITS, ASCII_DIGITS)


def snake_case(name: str) -> str:
    """``Discount Applied`` or ``discountApplied`` -> ``discount_applied``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_")
