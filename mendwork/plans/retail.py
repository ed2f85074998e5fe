"""Retail sales: rebuild prices, items, quantities and totals, then split into a star.

Only what follows from other columns is filled. An unknown discount stays unknown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.datetimes import iso_day, with_parsed_datetime
from mendwork.functions.numeric import to_boolean
from mendwork.operators.canonical import snake_case_columns
from mendwork.operators.impute import (
    fill_mode_hierarchy,
    infer_by_dependency,
    reconstruct_price,
    reconstruct_total,
)
from mendwork.operators.star import star_schema
from mendwork.session import materialise

# Dimension column -> id column.
DIMENSIONS = {
    "customer": "customer_id",
    "category": "category_id",
    "item": "item_id",
    "payment_method": "payment_method_id",
    "location": "location_id",
}


def add_date_parts(df: DataFrame, column: str, max_year: int | None = None) -> DataFrame:
    """ISO day, year and month of a date text."""
    parsed = with_parsed_datetime(
        df.withColumn("_day", F.col(column).cast("string")), "_day", "_stamp", max_year
    )
    return parsed.withColumns(
        {
            f"{column}_iso": iso_day(F.col("_stamp")),
            "transaction_year": F.year("_stamp"),
            "transaction_month": F.month("_stamp"),
        }
    ).drop("_day", "_stamp")


def clean(df: DataFrame, max_year: int | None = None) -> DataFrame:
    """Rename, read the discount flag, and fill price, item, quantity and total in turn."""
    named = snake_case_columns(df)
    dated = add_date_parts(named, "transaction_date", max_year)
    flagged = dated.withColumn("discount_applied", to_boolean(F.col("discount_applied")))
    priced = reconstruct_price(flagged, "price_per_unit", "total_spent", "quantity")
    itemised = infer_by_dependency(priced, ["category", "price_per_unit"], "item")
    counted = fill_mode_hierarchy(itemised, "quantity", [["item"], ["category"], []])
    return reconstruct_total(counted, "total_spent", "price_per_unit", "quantity")


# What is filled, and by which rule, in this order.
FILLED = {
    "price_per_unit": "total_spent / quantity, to the price step",
    "item": "the only item of its category and price",
    "quantity": "most frequent of the item, else of the category, else of all",
    "total_spent": "price_per_unit x quantity",
}


def renamed_columns(df: DataFrame) -> dict[str, str]:
    """Old name -> new name, where they differ."""
    return {a: b for a, b in zip(df.columns, snake_case_columns(df).columns, strict=True) if a != b}


def audit_document(df: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: renamed columns, and per filled column its rule, the values filled and those still missing."""
    before = snake_case_columns(df).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FILLED])
    after = cleaned.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in FILLED])
    both = after.withColumn("_b", before.select(F.struct(*FILLED)).scalar())

    def by_column(values: list[Column]) -> Column:
        return F.create_map(*[x for c, v in zip(FILLED, values, strict=True) for x in (F.lit(c), v)])

    return both.select(
        F.col("_rows").alias("rows"),
        F.create_map(*[F.lit(x) for pair in renamed_columns(df).items() for x in pair]).cast("map<string,string>").alias("renamed"),
        by_column([F.lit(r) for r in FILLED.values()]).alias("rules"),
        by_column([F.col(f"_b.{c}") - F.col(c) for c in FILLED]).alias("filled_values"),
        by_column([F.col(c) for c in FILLED]).alias("missing_values"),
    )


def star(cleaned: DataFrame, order_by: Sequence[str]) -> dict[str, DataFrame]:
    """``fact_sales`` with ``row_id`` and the five dimensions.

    The cleaned wide table is an output in its own right, so it is written once;
    the dimensions then each read one column instead of repeating the joins.
    """
    return star_schema(materialise(cleaned, "retail-wide"), DIMENSIONS, order_by, "row_id")
