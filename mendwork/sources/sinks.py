"""Text views for CSV files, and writers for tables and audit documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.fixed_values import NULL_TOKEN
from mendwork.functions.nulls import NullPolicy, blank_to_null
from mendwork.functions.numeric import float_text, whole_text
from mendwork.sources import delimited


def text_cell(text: Column) -> Column:
    """The text, or the NULL token where it is missing or blank."""
    return F.coalesce(blank_to_null(text, NullPolicy.BLANK), F.lit(NULL_TOKEN))


def cleansed_view(df: DataFrame) -> DataFrame:
    """id first, then the stripped originals as text."""
    columns = ["status", "time", "card_type", "city", "amount"]
    cells = [text_cell(_as_cell(df, c)).alias(c) for c in columns]
    return df.select(text_cell(whole_text(F.col("id"))).alias("id"), *cells)


def _as_cell(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    return whole_text(F.col(column)) if kind in ("double", "float") else F.col(column).cast("string")


def transformed_frame(df: DataFrame) -> DataFrame:
    """The typed output table: names in place of flags, amount as double."""
    return df.select(
        "id",
        "transaction_id",
        F.col("status_clean").alias("status"),
        F.col("date_clean").alias("date"),
        F.col("clock_time_clean").alias("time"),
        F.col("card_type_clean").alias("card_type"),
        F.col("city_clean").alias("city"),
        F.col("amount_clean").alias("amount"),
    )


def transformed_view(df: DataFrame) -> DataFrame:
    """The output table as text, with the NULL token for missing values."""
    typed = transformed_frame(df)
    plain = ["transaction_id", "status", "date", "time", "card_type", "city"]
    return typed.select(
        text_cell(whole_text(F.col("id"))).alias("id"),
        *[text_cell(F.col(c)).alias(c) for c in plain],
        text_cell(float_text(F.col("amount"))).alias("amount"),
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One file per partition, each with a header; texts come back as they are."""
    delimited.write(df, path, mode)


def write_document(one_row: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row frame as JSON (an audit or profile document)."""
    one_row.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    write: bool = True,
) -> None:
    """One sub-folder per table; ``write=False`` skips the tables (report-only run).

    Table by table: ``publish.publish`` shows readers all tables of a run at once.
    """
    if not write:
        return
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        if fmt == "csv":
            delimited.write(df, path, mode)
        else:
            df.write.mode(mode).format(fmt).save(path)
