"""Calorie efficiency: put scales and labels right, then split the wide table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.fixed_values import EFFICIENCY_MAP
from mendwork.functions.mapping import canonical
from mendwork.functions.numeric import fraction_to_percent, rescale_above, round_to_step
from mendwork.operators.canonical import drop_constant_columns, snake_case_columns
from mendwork.operators.keys import add_surrogate_key
from mendwork.operators.star import vertical_split

# Fraction column -> percent column.
PERCENTAGES = {
    "body_fat_percentage": "body_fat_pct",
    "muscle_mass_ratio": "muscle_mass_pct",
}


def rescaled(df: DataFrame, column: str = "efficiency_score") -> Column:
    """Flag of the values that were on the larger scale."""
    return F.coalesce(F.col(column) > 1, F.lit(False))


def clean(df: DataFrame, rounded: Sequence[str] = ()) -> DataFrame:
    """Rename, percentages, one score scale, whole heart rates, canonical labels."""
    named = snake_case_columns(df)
    changes = {
        "efficiency_score": rescale_above(F.col("efficiency_score")),
        "calorie_efficiency": canonical(F.col("calorie_efficiency"), EFFICIENCY_MAP),
    }
    changes |= {c: round_to_step(F.col(c)).cast("int") for c in rounded}
    changes |= {c: fraction_to_percent(F.col(c)) for c in PERCENTAGES if c in named.columns}
    return named.withColumns(changes).withColumnsRenamed(PERCENTAGES)


def split(
    df: DataFrame, order_by: Sequence[str], groups: Mapping[str, Sequence[str]]
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Drop constant columns, number the records, and split the columns into tables.

    Returns the tables and the dropped constants (for the audit document).
    """
    varying, constants = drop_constant_columns(df)
    keyed = add_surrogate_key(varying, order_by, "record_id", pattern=None)
    kept = {name: [c for c in cols if c not in constants] for name, cols in groups.items()}
    return vertical_split(keyed, "record_id", kept), constants


def audit_document(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """One row: renamed columns, scores brought to one scale, labels without a canonical value, dropped constants."""
    named = snake_case_columns(df)
    renames = {a: b for a, b in zip(df.columns, named.columns, strict=True) if a != b}
    renames |= {c: PERCENTAGES[c] for c in named.columns if c in PERCENTAGES}
    label = F.col("calorie_efficiency")
    known = canonical(label, EFFICIENCY_MAP)

    def as_map(pairs: Mapping[str, object]) -> Column:
        items = [F.lit(None if x is None else str(x)) for pair in pairs.items() for x in pair]
        return F.create_map(*items).cast("map<string,string>")

    return named.agg(
        F.count("*").alias("rows"),
        F.count_if(rescaled(named)).alias("rescaled_rows"),
        F.count_if(label.isNotNull() & known.isNull()).alias("unmapped_label_rows"),
    ).select("*", as_map(renames).alias("renamed"), as_map(constants).alias("dropped_constants"))
