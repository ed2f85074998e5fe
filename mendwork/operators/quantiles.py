"""Exact quantiles of columns of any size, by one path.

A mergeable quantile sketch (Greenwald-Khanna, its ranks are off by at most one in ``ACCURACY``) gives two values
that surely enclose the wanted rank: the bracket. One more scan counts the distinct values inside the brackets and
the rows outside of them, and the rank is looked up among these counts. Where a bracket may still hold too many
values for one task, it is first narrowed by a sketch of the rows inside it; how often depends on counts alone.
Only sketches and counts are shuffled, so a value held by a third of all rows costs one counter per task.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from mendwork.session import materialise

# Distinct values of a group that one task may sort; a bracket that may hold more is narrowed.
RANGE_ROWS = 100_000
# Ranks of the sketch are off by at most one row in so many.
ACCURACY = 10_000
# How far from the wanted share the first bracket's ends are asked for: ten times that error.
MARGIN = 0.001
# Marks that a later sketch sets inside a bracket.
MARKS = 1000
# With fewer rows a bracket is not narrowed: the margins would be less than a row.
LEAST_ROWS = 4 * MARKS

_INF = float("inf")


def interpolated(low: Column, high: Column, share: Column) -> Column:
    """Between two neighbours, from the nearer one; equal neighbours (infinities too) stay as they are."""
    step = high - low
    return (
        F.when((low == high) | (share == 0), low)
        .when(share < 0.5, low + step * share)
        .otherwise(high - step * (1 - share))
    )


def _position(total: Column, p: float) -> Column:
    return (total - 1) * p


def _sketch(probs: Sequence[float]) -> list[Column]:
    """The number of values, and two values per probability that enclose the wanted rank."""
    ends = [min(1.0, max(0.0, p + side)) for p in probs for side in (-MARGIN, MARGIN)]
    return [F.count("_v").alias("n"), F.percentile_approx("_v", ends, ACCURACY).alias("_ends")]


def _first_brackets(sketched: DataFrame, keys: Sequence[str], probs: Sequence[float], limit: int) -> DataFrame:
    """Per group: the number of values, each bracket's ends and how many values may lie strictly inside."""
    narrowed = F.col("n") > limit
    inside = (F.col("n") * (2 * MARGIN + 2 / ACCURACY)).cast("long")
    columns = []
    for i in range(len(probs)):
        columns.append(F.when(narrowed, F.get("_ends", F.lit(2 * i))).otherwise(-_INF).alias(f"_low{i}"))
        columns.append(F.when(narrowed, F.get("_ends", F.lit(2 * i + 1))).otherwise(_INF).alias(f"_high{i}"))
    columns.append(F.when(narrowed, inside).otherwise(F.col("n")).alias("_inside"))
    return sketched.select(*keys, "n", *columns)


def _narrower(bounded: DataFrame, keys: Sequence[str], probs: Sequence[float], limit: int) -> DataFrame:
    """The brackets again, each cut down by a sketch of the values strictly inside it.

    ``bounded`` has the rows with the brackets of their groups.
    """
    marks = [i / MARKS for i in range(MARKS + 1)]
    v, aggregates = F.col("_v"), [F.first("n").alias("n")]
    for i in range(len(probs)):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        inner = (v > low) & (v < high)
        aggregates += [
            F.count_if(v <= low).alias(f"_upto{i}"),
            F.count_if(inner).alias(f"_inner{i}"),
            F.percentile_approx(F.when(inner, v), marks, ACCURACY).alias(f"_marks{i}"),
            F.first(low).alias(f"_low{i}"),
            F.first(high).alias(f"_high{i}"),
        ]
    found = bounded.groupBy(*keys).agg(*aggregates)
    columns, inside = [], []
    for i, p in enumerate(probs):
        inner = F.col(f"_inner{i}")
        share = F.try_divide(F.floor(_position(F.col("n"), p)) - F.col(f"_upto{i}"), inner)
        at = F.floor(share * MARKS).cast("int")
        cut = inner > LEAST_ROWS
        # Beyond the marks a bracket keeps its end.
        columns.append(F.when(cut & (at >= 1), F.get(f"_marks{i}", at - 1)).otherwise(F.col(f"_low{i}")).alias(f"_low{i}"))
        columns.append(F.when(cut & (at <= MARKS - 2), F.get(f"_marks{i}", F.greatest(at, F.lit(-1)) + 2)).otherwise(F.col(f"_high{i}")).alias(f"_high{i}"))
        inside.append(F.when(cut, (inner * (4 / MARKS)).cast("long")).otherwise(F.least(inner, F.lit(limit))))
    return found.select(*keys, "n", *columns, functools.reduce(F.greatest, inside, F.lit(0).cast("long")).alias("_inside"))


def _with_numbers(rows: DataFrame, bracket: Mapping[str, Any]) -> DataFrame:
    """Every row with the numbers of the one bracket row in the plan."""
    return rows.select("_v", *[F.lit(x).alias(c) for c, x in bracket.items() if c == "n" or c.startswith(("_low", "_high"))])


def _with_brackets(rows: DataFrame, brackets: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Every row with its group's brackets; groups without any keep all their values inside."""
    bounds = [c for c in brackets.columns if c.startswith(("_low", "_high"))]
    renamed = brackets.select(*[F.col(f"`{k}`").alias(f"_p_{k}") for k in keys], "n", *bounds)
    joined = rows.join(renamed, [rows[f"`{k}`"].eqNullSafe(renamed[f"`_p_{k}`"]) for k in keys], how)
    open_ends = [F.coalesce(c, F.lit(-_INF if c.startswith("_low") else _INF)).alias(c) for c in bounds]
    return joined.select(*rows.columns, "n", *open_ends)


def _look_up(bounded: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per group the number of values and, per probability, those on both sides of the wanted position."""
    v = F.col("_v")
    ends = [(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in range(len(probs))]
    inside = functools.reduce(operator.or_, [(v >= low) & (v <= high) for low, high in ends])
    # Rows outside the brackets count for the nearest bracket's end below them, and stand behind it.
    below = [F.when(high < v, high) for _, high in ends]
    end = F.greatest(*below) if len(below) > 1 else below[0]
    # Rows without a value count as none, so that their group is there.
    spot = F.struct(F.coalesce(F.when(inside, v).otherwise(end), F.lit(-_INF)).alias("at"), (~inside).alias("gap"))
    counted = bounded.groupBy(*keys, F.when(v.isNotNull(), spot).alias("_spot")).agg(F.count("_v").alias("_n"))
    summed = counted.select(
        *keys,
        "_spot",
        F.sum("_n").over(Window.partitionBy(*keys).orderBy("_spot")).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
    )
    hits = []
    for i, p in enumerate(probs):
        position = _position(F.col("_total"), p)
        for side, rank in (("l", F.floor(position)), ("h", F.ceil(position))):
            hits.append(F.min(F.when(F.col("_upto") > rank, F.col("_spot"))).alias(f"_{side}{i}"))
    return summed.groupBy(*keys).agg(F.coalesce(F.max("_total"), F.lit(0).cast("long")).alias("n"), *hits)


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    above: float | None = None,
    range_rows: int = RANGE_ROWS,
    write: bool | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation, per group of ``by`` (or one row overall).

    Output: the ``by`` columns, ``n`` and one column ``q0``, ``q1``, … per
    probability. NULL and NaN are left out; an empty population gives NULLs. Values not
    ``above`` a limit are left out. The doubles do not depend on size or partitions.

    Both scans read one numeric column. Unless ``value`` is a column's name it is written first, so that
    what it is computed from is read once (``write`` overrides that).
    """
    source = (F.col(f"`{value}`") if isinstance(value, str) else value).cast("double")
    keys, limit = list(by), max(range_rows, LEAST_ROWS)
    # NaN is the largest double, so this keeps neither NULL nor NaN. -0.0 and 0.0 are one value.
    kept = F.col("_v") < float("nan")
    if above is not None:
        kept = kept & (F.col("_v") > above)
    rows = df.select(*[F.col(f"`{k}`") for k in keys], source.alias("_v"))
    rows = rows.select(*keys, F.when(kept, F.col("_v") + F.lit(0.0)).alias("_v"))
    write = not isinstance(value, str) if write is None else write

    rows = materialise(rows, "numbers") if write else rows
    if not keys:
        bracket = _first_brackets(rows.agg(*_sketch(probs)), keys, probs, limit).first().asDict()
        while bracket["_inside"] > limit:
            bracket = _narrower(_with_numbers(rows, bracket), keys, probs, limit).first().asDict()
        bounded = _with_numbers(rows, bracket)
    else:
        counts = rows.groupBy(*keys).agg(F.count("_v").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= limit:
            open_ends = [F.lit(end).alias(f"{name}{i}") for i in range(len(probs)) for name, end in (("_low", -_INF), ("_high", _INF))]
            bounded = rows.select("*", *open_ends)
        else:
            # Only groups with many values get sketches. Written, so that Spark knows the size when it plans the
            # join, and no step repeats the ones before it.
            large = materialise(counts.where(F.col("n") > limit), "large-groups")
            sketched = _with_brackets(rows, large, keys, "inner").drop("n").groupBy(*keys).agg(*_sketch(probs))
            large = materialise(_first_brackets(sketched, keys, probs, limit), "brackets")
            while (large.agg(F.max("_inside")).first()[0] or 0) > limit:
                large = materialise(_narrower(_with_brackets(rows, large, keys, "inner"), keys, probs, limit), "brackets")
            bounded = _with_brackets(rows, large, keys, "left")
    found = _look_up(bounded, keys, probs)

    def between(i: int, p: float) -> Column:
        position = _position(F.col("n"), p)
        missed = F.col(f"_l{i}.gap") | F.col(f"_h{i}.gap")
        value = interpolated(F.col(f"_l{i}.at"), F.col(f"_h{i}.at"), position - F.floor(position))
        return F.when(missed, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).otherwise(value).alias(f"q{i}")

    return found.select(*keys, "n", *[between(i, p) for i, p in enumerate(probs)])


def exact_median(df: DataFrame, value: str | Column, by: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, value, [0.5], by).withColumnRenamed("q0", "median")
