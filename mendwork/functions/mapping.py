"""Spelling variants to canonical values."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from mendwork.functions.text import strip


def canonical(text: Column, mapping: Mapping[str, str], stripped: bool = False) -> Column:
    """Canonical value of a text by its trimmed lower-case spelling, NULL when unknown.

    For mappings that are small enough to write down; see
    ``operators.canonical.canonicalise_by_table`` for mappings held in a table.
    """
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, F.lower(text if stripped else strip(text)))


def is_unmapped(text: Column, canon: Column, stripped: bool = False) -> Column:
    """True where a text is present but has no canonical value."""
    trimmed = text if stripped else strip(text)
    return canon.isNull() & F.coalesce(trimmed != "", F.lit(False))
