"""Dense surrogate keys in row order.

One path for every size: the rows are cut into ranges of the whole order key, at
boundaries that Spark samples, so the ranges have about equally many rows whatever
the values are. The task that holds a range sorts it, numbers its rows and writes them;
the ranges are counted, and a row's key is its number behind the ranges before its own.
The rows move once. No task holds more than a range, and a lost task is repeated from
the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from mendwork.session import materialise

# Spark's increasing ids number the rows of a task in the lower 33 bits.
TASK_BITS = 33


def with_row_rank(
    df: DataFrame, order_by: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """Add the dense position (from 1) of every row in the order of ``order_by``.

    The order columns should identify a row together: rows that tie on all of them
    share a range and are numbered in no particular order. ``slices`` is the number of
    ranges; left unset, Spark's shuffle settings decide.
    """
    order = [F.col(f"`{c}`") for c in order_by]
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    # An increasing id has the row's place in its task in the lower bits.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    placed = ranged.sortWithinPartitions(*order).withColumns({"_slice": F.spark_partition_id(), "_at": place})
    rows = materialise(placed, "ranked")
    # One row per range.
    sizes = rows.groupBy("_slice").agg(F.count("*").alias("_n"))
    starts = sizes.select(
        "_slice", (F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")).alias("_start")
    )
    numbered = rows.join(F.broadcast(starts), "_slice")
    columns = [F.col(f"`{c}`") for c in df.columns]
    return numbered.select(*columns, (F.col("_start") + F.col("_at") + 1).alias(name))


def add_surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "transaction_id",
    pattern: str | None = "TRX_%05d",
    slices: int | None = None,
) -> DataFrame:
    """Dense unique key in row order, ``TRX_00001`` upwards (plain number if no pattern)."""
    ranked = with_row_rank(df, order_by, "_rank", slices)
    key = F.format_string(pattern, F.col("_rank")) if pattern else F.col("_rank")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], key.alias(name))
