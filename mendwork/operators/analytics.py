"""Questions asked of the cleaned data, and follow-up checks on privacy and bias."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.numeric import percent


def success_rate(
    df: DataFrame, group: Column, status: Column, success: str = "success", name: str = "city"
) -> DataFrame:
    """Rows, successes and success share per group."""
    grouped = df.select(group.alias(name), status.alias("_status")).groupBy(name)
    counts = grouped.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("_status") == success).alias("success_rows"),
    )
    return counts.withColumn("success_pct", percent(F.col("success_rows"), F.col("row_count")))


def revenue(df: DataFrame, group: Column, amount: Column, name: str = "card_type") -> DataFrame:
    """Sum and number of amounts per group; missing amounts are left out and counted.

    Summed as decimals, so the result does not depend on the order of the rows.
    """
    grouped = df.select(group.alias(name), amount.alias("_x")).groupBy(name)
    return grouped.agg(
        F.sum(F.col("_x").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.count("_x").alias("amount_rows"),
        F.count_if(F.col("_x").isNull()).alias("null_amount_rows"),
    )


def null_cluster(df: DataFrame, by: Mapping[str, Column], flags: Mapping[str, Column]) -> DataFrame:
    """Share of flagged rows per group and per leading part of the group (rollup)."""
    staged = df.select(
        *[c.alias(n) for n, c in by.items()], *[f.alias(f"_f_{n}") for n, f in flags.items()]
    )
    counts = staged.rollup(*by).agg(
        F.grouping_id().cast("long").alias("grouping_level"),
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(f"_f_{n}")).alias(f"{n}_rows") for n in flags],
    )
    shares = [percent(F.col(f"{n}_rows"), F.col("row_count")).alias(f"{n}_pct") for n in flags]
    return counts.select("*", *shares)


def time_bucket(df: DataFrame, column: str, unit: str, out: str | None = None) -> DataFrame:
    """Coarsen a timestamp for sharing (hour, day, month, …)."""
    return df.withColumn(out or column, F.date_trunc(unit, F.col(column)))


def quasi_identifier_uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows share their combination of values with how many others."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("group_size"))
    sizes = groups.groupBy("group_size").agg(F.count("*").alias("groups"))
    return sizes.withColumn("row_count", F.col("group_size") * F.col("groups"))
