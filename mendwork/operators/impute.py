"""Dropping, filling and reconstructing missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.nulls import NullPolicy, is_missing
from mendwork.functions.numeric import round_to_step
from mendwork.operators.quantiles import exact_median
from mendwork.session import materialise


def drop_critical(
    df: DataFrame, columns: Sequence[str], policy: NullPolicy = NullPolicy.NA_TOKENS
) -> DataFrame:
    """Drop rows in which a critical column is missing."""
    missing = is_missing(df, columns[0], policy)
    for c in columns[1:]:
        missing = missing | is_missing(df, c, policy)
    return df.filter(~missing)


def drop_critical_count(
    df: DataFrame, columns: Sequence[str], policy: NullPolicy = NullPolicy.NA_TOKENS
) -> DataFrame:
    """One row: rows before, dropped and left."""
    kept = drop_critical(df, columns, policy).agg(F.count("*"))
    counts = df.agg(F.count("*").alias("rows_before")).withColumn("rows_left", kept.scalar())
    return counts.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_left"))


def fill_unknown(
    df: DataFrame,
    columns: Sequence[str],
    value: str = "Unknown",
    policy: NullPolicy = NullPolicy.NA_TOKENS,
) -> DataFrame:
    filled = {
        c: F.when(is_missing(df, c, policy), F.lit(value)).otherwise(F.col(c)) for c in columns
    }
    return df.withColumns(filled)


def fill_median(
    df: DataFrame,
    number: str,
    valid: Column | None = None,
    out: str | None = None,
) -> DataFrame:
    """Replace missing or invalid numbers by the median of the valid ones.

    Adds ``<out>_imputed_flag``. The median is found by a job of its own.
    """
    out = out or number
    kept = F.nanvl(F.col(number).cast("double"), F.lit(None).cast("double"))
    if valid is not None:
        kept = F.when(valid, kept)
    median = exact_median(df, kept).select("median").first()[0]
    flagged = df.withColumn(f"{out}_imputed_flag", kept.isNull())
    return flagged.withColumn(out, F.coalesce(kept, F.lit(median).cast("double")))


def reconstruct_price(
    df: DataFrame, price: str, total: str, quantity: str, step: float = 0.5
) -> DataFrame:
    """Missing price = total / quantity, to the price step."""
    quotient = F.try_divide(F.col(total), F.col(quantity))
    return df.withColumn(price, F.coalesce(F.col(price), round_to_step(quotient, step)))


def reconstruct_total(df: DataFrame, total: str, price: str, quantity: str) -> DataFrame:
    """Missing total = price x quantity."""
    return df.withColumn(total, F.coalesce(F.col(total), F.col(price) * F.col(quantity)))


def dependency_table(df: DataFrame, given: Sequence[str], inferred: str) -> DataFrame:
    """Per combination of the given columns: the value, and whether it is the only one.

    Smallest = largest proves a single value without collecting the set of values.
    """
    known = df.dropna(subset=[*given, inferred])
    return known.groupBy(*given).agg(
        F.min(inferred).alias(inferred),
        (F.min(inferred) == F.max(inferred)).alias("is_unique"),
        F.count("*").alias("support"),
    )


def infer_by_dependency(df: DataFrame, given: Sequence[str], inferred: str) -> DataFrame:
    """Fill a missing column where the given columns determine it.

    The rules are written first, so that the join is planned with their real size.
    """
    table = dependency_table(df, given, inferred).filter("is_unique")
    rules = materialise(table.select(*given, F.col(inferred).alias("_rule")), "rules")
    filled = df.join(rules, list(given), "left").withColumn(
        inferred, F.coalesce(F.col(inferred), F.col("_rule"))
    )
    return filled.select(*df.columns)


def most_frequent(df: DataFrame, value: str, by: Sequence[str], out: str = "mode") -> DataFrame:
    """Mode per group, ties to the smallest value.

    Counting (group, value) pairs first keeps a group that holds most of the rows
    from gathering in one task.
    """
    pairs = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    return _mode(pairs, value, by, out)


def _mode(pairs: DataFrame, value: str, by: Sequence[str], out: str) -> DataFrame:
    return pairs.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def fill_mode_hierarchy(df: DataFrame, value: str, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Fill from the mode of the finest group that has one; an empty level is global.

    The rows are counted once, by the columns of all levels; every level adds up from
    that table.
    """
    filled, fallback = df, F.col(value)
    every = list(dict.fromkeys(c for by in levels for c in by))
    known = df.filter(F.col(value).isNotNull())
    counts = materialise(known.groupBy(*every, value).agg(F.count("*").alias("_n")), "counts")
    for i, by in enumerate(levels):
        pairs = counts.groupBy(*by, value).agg(F.sum("_n").alias("_n"))
        if by:
            table = materialise(_mode(pairs, value, by, f"_mode{i}"), "modes")
            filled = filled.join(table, list(by), "left")
            fallback = F.coalesce(fallback, F.col(f"_mode{i}"))
        else:
            mode = _mode(pairs, value, [], "_mode").first()[0]
            fallback = F.coalesce(fallback, F.lit(mode).cast(df.schema[value].dataType))
    return filled.withColumn(value, fallback).select(*df.columns)
