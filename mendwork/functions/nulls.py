"""What counts as a missing value."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mendwork.functions.fixed_values import NA_TOKENS, NULL_TOKEN
from mendwork.functions.text import SPACES

# White space is matched possessively, so that a long run of it is read only once.
_BLANK = f"^(?:{SPACES}+)?\\z"
_NULL_LIKE = f"(?i)^(?:{SPACES}+)?(?:{NULL_TOKEN}(?:{SPACES}+)?)?\\z"


class NullPolicy(Enum):
    """Three definitions of missing, from narrow to wide."""

    STRICT = "strict"  # SQL NULL (and NaN) only
    NA_TOKENS = "na_tokens"  # NULL, or exactly one of the default reader's tokens
    BLANK = "blank"  # NULL, or nothing but white space
    NULL_LIKE = "null_like"  # NULL, blank, or the text NULL in any case


def is_missing_text(text: Column, policy: NullPolicy = NullPolicy.NULL_LIKE) -> Column:
    """Never-null flag for a text column."""
    if policy is NullPolicy.STRICT:
        return text.isNull()
    if policy is NullPolicy.NA_TOKENS:
        return F.coalesce(text.isin(*NA_TOKENS), F.lit(True))
    # Anchored patterns give up at the first other character, where trimming would
    # walk through a long text from both ends.
    pattern = _BLANK if policy is NullPolicy.BLANK else _NULL_LIKE
    return F.coalesce(text.rlike(pattern), F.lit(True))


def is_null_like(text: Column) -> Column:
    """NULL, blank, or the text ``NULL`` in any case."""
    return is_missing_text(text, NullPolicy.NULL_LIKE)


def is_missing(df: DataFrame, column: str, policy: NullPolicy = NullPolicy.NULL_LIKE) -> Column:
    """Flag by column type: text follows the policy, NaN counts as missing in floats."""
    col, dtype = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return is_missing_text(col, policy)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def blank_to_null(text: Column, policy: NullPolicy = NullPolicy.NULL_LIKE) -> Column:
    """The text itself, or NULL where the policy calls it missing."""
    return F.when(~is_missing_text(text, policy), text)
