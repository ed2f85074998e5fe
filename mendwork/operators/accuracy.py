"""Validity of amounts and of date and clock texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.datetimes import datetime_status, matched_time_layout, written_hour
from mendwork.functions.fixed_values import AMOUNT_LABELS
from mendwork.functions.numeric import percent, to_number
from mendwork.functions.text import strip
from mendwork.operators.report import spread


def amount_status(text: Column) -> Column:
    """valid (above zero once words are read and the sign dropped), invalid, or NULL."""
    return (
        F.when(F.coalesce(strip(text) == "", F.lit(True)), "NULL")
        .when(F.abs(to_number(text)) > 0, "valid")
        .otherwise("invalid")
    )


def status_summary(df: DataFrame, status: Column, statuses: Sequence[str]) -> DataFrame:
    """Count and share of every listed status, zero included."""
    staged = df.select(status.alias("_s"))
    counts = staged.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col("_s") == s).alias(f"_n{i}") for i, s in enumerate(statuses)],
    )
    rows = [
        (F.lit(s), F.col(f"_n{i}"), percent(F.col(f"_n{i}"), F.col("_rows")))
        for i, s in enumerate(statuses)
    ]
    return spread(counts, ["status", "row_count", "pct_of_total_rows"], rows)


def amount_accuracy(df: DataFrame, column: str) -> DataFrame:
    return status_summary(df, amount_status(F.col(column)), ["valid", "invalid", "NULL"])


def amount_accuracy_detail(df: DataFrame, column: str) -> DataFrame:
    """How many amounts are not numbers, and how many are negative."""
    staged = df.select(strip(F.col(column)).alias("_t"), to_number(F.col(column)).alias("_x"))
    counts = staged.agg(
        F.count_if(F.col("_x").isNull() & (F.col("_t") != "")).alias("_text"),
        F.count_if(F.col("_x") < 0).alias("_negative"),
    )
    rows = [
        (F.lit(AMOUNT_LABELS["text"]), F.col("_text")),
        (F.lit(AMOUNT_LABELS["negative"]), F.col("_negative")),
    ]
    return spread(counts, ["metric", "value"], rows)


def datetime_accuracy(df: DataFrame, column: str) -> DataFrame:
    statuses = ["valid", "impossible_date_or_time", "invalid", "NULL"]
    return status_summary(df, datetime_status(F.col(column)), statuses)


def datetime_format_split(df: DataFrame, column: str) -> DataFrame:
    """Valid rows by the layout they are written in."""
    staged = df.select(matched_time_layout(F.col(column)).alias("valid_format"))
    valid = staged.filter(F.col("valid_format") != "invalid_format")
    return valid.groupBy("valid_format").agg(F.count("*").alias("row_count"))


def status_examples(
    df: DataFrame, status: Column, wanted: str, order_by: Sequence[str], n: int = 50
) -> DataFrame:
    """The first ``n`` rows of one status."""
    return df.filter(status == wanted).orderBy(*order_by).limit(n)


def hour_summary(df: DataFrame, column: str) -> DataFrame:
    """Rows with a written hour, and those beyond 24."""
    hours = df.select(written_hour(F.col(column)).alias("_h"))
    return hours.agg(
        F.count("_h").alias("hours_collected"), F.count_if(F.col("_h") > 24).alias("hours_over_24")
    )


def hour_histogram(df: DataFrame, column: str) -> DataFrame:
    hours = df.select(written_hour(F.col(column)).alias("hour")).filter("hour IS NOT NULL")
    return hours.groupBy("hour").agg(F.count("*").alias("row_count"))
