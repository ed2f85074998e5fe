"""Turning one row of counters into a report of several rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_where(flag: Column) -> Column:
    return F.count_if(flag)


def spread(one_row: DataFrame, names: Sequence[str], rows: Sequence[Sequence[Column]]) -> DataFrame:
    """``rows`` are tuples of expressions over ``one_row``; all become output rows.

    A single aggregate feeds any number of report rows this way, and rows whose
    count is zero are there without a join against a list of labels.
    """
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))
