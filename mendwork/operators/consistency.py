"""Distinct values, formats, and how two data sets compare on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mendwork.functions.datetimes import stamp_format_status
from mendwork.functions.formats import kind_of
from mendwork.functions.nulls import is_null_like
from mendwork.functions.numeric import percent, to_number
from mendwork.functions.text import strip
from mendwork.operators.keys import with_row_rank
from mendwork.operators.report import spread


def count_by(df: DataFrame, label: Column, name: str) -> DataFrame:
    """Rows per label and their share of all rows, most frequent first."""
    counts = df.groupBy(label.alias(name)).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    shares = counts.withColumn("pct_of_total_rows", percent(F.col("row_count"), total))
    return shares.orderBy(F.desc("row_count"), F.asc(name))


def value_label(text: Column) -> Column:
    """The trimmed text, with labels for missing and blank ones."""
    return F.when(text.isNull(), "<NULL>").otherwise(
        F.regexp_replace(strip(text), "^$", "<BLANK>")
    )


def value_profile(df: DataFrame, column: str) -> DataFrame:
    return count_by(df, value_label(F.col(column).cast("string")), column)


def number_kind_profile(df: DataFrame, column: str) -> DataFrame:
    """integer / decimal / non_numeric / NULL counts of a text column."""
    text = strip(F.col(column))
    # Parsed once: Spark keeps a projection whose columns are used several times.
    staged = df.select(text.alias("_t"), to_number(text, None, stripped=True).alias("_x"))
    return count_by(staged, kind_of(F.col("_t"), F.col("_x")), f"{column}_format_type")


def samples_per_group(
    df: DataFrame, label: Column, name: str, order_by: Sequence[str], n: int = 20
) -> DataFrame:
    """The first ``n`` rows of every class.

    The rank filter lets Spark keep ``n`` rows per class and task before the
    shuffle, so a class with most of the rows costs no more than the others.
    """
    labelled = df.withColumn(name, label)
    rank = F.row_number().over(Window.partitionBy(name).orderBy(*order_by))
    return labelled.withColumn("sample_no", rank.cast("long")).filter(F.col("sample_no") <= n)


def time_format_check(df: DataFrame, column: str) -> DataFrame:
    """valid / invalid counts against the one layout ``YYYY-MM-DD HH:MM:SS``."""
    good = stamp_format_status(F.col(column)) == "valid"
    counts = df.agg(F.count_if(good).alias("_valid"), F.count_if(~good).alias("_invalid"))
    rows = [(F.lit("valid"), F.col("_valid")), (F.lit("invalid"), F.col("_invalid"))]
    return spread(counts, ["status", "row_count"], rows)


def time_format_examples(
    df: DataFrame, column: str, order_by: Sequence[str], n: int = 50
) -> DataFrame:
    """The first rows whose time is not in the one layout."""
    bad = df.filter(stamp_format_status(F.col(column)) == "invalid")
    return bad.orderBy(*order_by).limit(n).select(*order_by, column)


def format_comparison(*parts: tuple[DataFrame, str, Column]) -> DataFrame:
    """(dataset, format, row_count) of several columns under each other."""
    tables = [
        df.groupBy(kind.alias("format"))
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("dataset"), "format", "row_count")
        for df, name, kind in parts
    ]
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table)
    return stacked.orderBy("dataset", F.desc("row_count"), "format")


def distinct_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct trimmed values that are not null-like."""
    trimmed = strip(F.col(column).cast("string")).alias(name)
    return df.filter(~is_null_like(F.col(column).cast("string"))).select(trimmed).distinct()


def side_by_side_values(
    left: DataFrame, left_column: str, right: DataFrame, right_column: str,
    left_name: str | None = None, right_name: str | None = None,
) -> DataFrame:
    """Sorted distinct values of two columns, aligned by position."""
    a, b = left_name or f"left_{left_column}", right_name or f"right_{right_column}"
    x = with_row_rank(distinct_values(left, left_column, a), [a], "position")
    y = with_row_rank(distinct_values(right, right_column, b), [b], "position")
    return x.join(y, "position", "full_outer").select("position", a, b)


def comparison_summary(
    raw: DataFrame,
    norm: DataFrame,
    raw_kinds: dict[str, Column],
    norm_kinds: dict[str, Column],
    values: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Rows, format buckets and distinct values of two data sets.

    ``raw_kinds`` and ``norm_kinds`` map a check to its format class; a check given
    as ``name#part`` adds up over its parts. ``values`` lists (check, raw column,
    norm column) whose distinct values are counted.
    """

    def measure(df: DataFrame, kinds: dict[str, Column], columns: Sequence[tuple[str, str]]):
        # The format classes are few, so their sets stay small in every task; only the
        # values, which may be many, need the shuffle of a distinct count.
        sets = [
            F.size(F.collect_set(kind)).cast("long").alias(f"_k{i}")
            for i, kind in enumerate(kinds.values())
        ]
        uniques = [
            F.count_distinct(
                F.when(~is_null_like(F.col(c).cast("string")), strip(F.col(c).cast("string")))
            ).alias(f"_u{i}")
            for i, (_, c) in enumerate(columns)
        ]
        return df.agg(F.count("*").alias("_rows"), *sets, *uniques)

    left = measure(raw, raw_kinds, [(name, a) for name, a, _ in values])
    right = measure(norm, norm_kinds, [(name, b) for name, _, b in values])
    both = left.select(
        F.struct("*").alias("l"), right.select(F.struct("*")).scalar().alias("r")
    )

    def buckets(side: str, kinds: dict[str, Column], check: str) -> Column:
        parts = [i for i, k in enumerate(kinds) if k.split("#")[0] == check]
        return sum((F.col(f"{side}._k{i}") for i in parts[1:]), F.col(f"{side}._k{parts[0]}"))

    rows = [(F.lit("rows"), F.col("l._rows"), F.col("r._rows"))]
    for check in dict.fromkeys(k.split("#")[0] for k in raw_kinds):
        rows.append(
            (F.lit(check), buckets("l", raw_kinds, check), buckets("r", norm_kinds, check))
        )
    for i, (check, _, _) in enumerate(values):
        rows.append((F.lit(check), F.col(f"l._u{i}"), F.col(f"r._u{i}")))
    return spread(both, ["check", "transaction", "normalised"], rows)
