"""How much is missing, per column, per table, per row pattern, before and after."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.nulls import NullPolicy, is_missing
from mendwork.functions.numeric import percent
from mendwork.operators.report import spread


def _missing_counts(
    df: DataFrame, columns: Sequence[str], policy: NullPolicy, prefix: str = "_m"
) -> DataFrame:
    """One row: the row count and the missing count of every column, in one scan."""
    flags = [F.count_if(is_missing(df, c, policy)).alias(f"{prefix}{i}") for i, c in enumerate(columns)]
    return df.agg(F.count("*").alias(f"{prefix}_rows"), *flags)


def column_completeness(
    df: DataFrame, policy: NullPolicy = NullPolicy.NA_TOKENS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Per column: rows, missing and complete counts and percentages, worst first."""
    columns = list(columns or df.columns)
    total = F.col("_m_rows")

    def row(i: int, column: str) -> tuple[Column, ...]:
        missing = F.col(f"_m{i}")
        complete = total - missing
        return (
            F.lit(column),
            total,
            missing,
            percent(missing, total),
            complete,
            percent(complete, total),
        )

    names = ["column", "total_rows", "missing_count", "missing_pct", "complete_count", "complete_pct"]
    table = spread(
        _missing_counts(df, columns, policy), names, [row(i, c) for i, c in enumerate(columns)]
    )
    return table.orderBy(F.desc("missing_count"), F.asc("column"))


def overall_completeness(df: DataFrame, policy: NullPolicy = NullPolicy.NA_TOKENS) -> DataFrame:
    """One row: rows, columns, cells, and missing and complete cells."""
    counts = _missing_counts(df, df.columns, policy)
    missing = sum((F.col(f"_m{i}") for i in range(1, len(df.columns))), F.col("_m0"))
    sized = counts.select(
        F.col("_m_rows").alias("total_rows"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        (F.col("_m_rows") * len(df.columns)).alias("total_cells"),
        missing.alias("missing_cells"),
    )
    complete = F.col("total_cells") - F.col("missing_cells")
    return sized.select(
        "*",
        percent(F.col("missing_cells"), F.col("total_cells")).alias("missing_pct"),
        complete.alias("complete_cells"),
        percent(complete, F.col("total_cells")).alias("complete_pct"),
    )


def missing_before_after(
    before: DataFrame,
    after: DataFrame,
    columns: Sequence[str] | None = None,
    policy: NullPolicy = NullPolicy.NA_TOKENS,
) -> DataFrame:
    """Missing count of every column before and after a treatment."""
    columns = list(columns or before.columns)
    left = _missing_counts(before, columns, policy)
    right = _missing_counts(after, columns, policy)
    both = left.withColumn("_after", right.select(F.struct("*")).scalar())
    rows = [
        (F.lit(c), F.col(f"_m{i}"), F.col(f"_after._m{i}")) for i, c in enumerate(columns)
    ]
    return spread(both, ["column", "before_missing", "after_missing"], rows)


def missing_flags(df: DataFrame, policy: NullPolicy = NullPolicy.NA_TOKENS) -> DataFrame:
    """The 0/1 matrix itself: one flag column per column, row by row."""
    return df.select(*[is_missing(df, c, policy).cast("int").alias(c) for c in df.columns])


def missing_pattern(df: DataFrame, policy: NullPolicy = NullPolicy.NA_TOKENS) -> DataFrame:
    """Which columns are missing together, and in how many rows."""
    flags = missing_flags(df, policy)
    return flags.groupBy(*flags.columns).agg(F.count("*").alias("row_count"))


def structured_missingness(
    df: DataFrame, columns: Sequence[str], policy: NullPolicy = NullPolicy.NULL_LIKE
) -> DataFrame:
    """Row counts per set of columns that are missing in the same row (two or more)."""
    names = [F.when(is_missing(df, c, policy), F.lit(c)) for c in columns]
    sets = df.select(F.concat_ws(",", *names).alias("missing_together"))
    counted = sets.groupBy("missing_together").agg(F.count("*").alias("row_count"))
    return counted.filter(F.instr("missing_together", ",") > 0)


def null_table(
    df: DataFrame, dataset: str, policy: NullPolicy = NullPolicy.NULL_LIKE
) -> DataFrame:
    """Null-like count and percentage per column of one data set."""
    total = F.col("_m_rows")
    rows = [
        (F.lit(dataset), F.lit(c), total, F.col(f"_m{i}"), percent(F.col(f"_m{i}"), total))
        for i, c in enumerate(df.columns)
    ]
    names = ["dataset", "column", "total_rows", "null_count", "null_pct"]
    return spread(_missing_counts(df, df.columns, policy), names, rows)


def null_tables(*named: tuple[DataFrame, str]) -> DataFrame:
    """The null tables of several data sets under each other, worst columns first."""
    tables = [null_table(df, name) for df, name in named]
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table)
    return stacked.orderBy("dataset", F.desc("null_count"), "column")


def null_delta(
    source: DataFrame,
    target: DataFrame,
    column_map: Mapping[str, str],
    source_name: str = "transaction",
    target_name: str = "normalised",
    policy: NullPolicy = NullPolicy.NULL_LIKE,
) -> DataFrame:
    """Null-like counts of mapped columns in two data sets; NULL where a column is absent."""
    src = [c for c in column_map if c in source.columns]
    dst = [c for c in column_map.values() if c in target.columns]
    left = _missing_counts(source, src, policy)
    right = _missing_counts(target, dst, policy)
    both = left.withColumn("_t", right.select(F.struct("*")).scalar())
    absent = F.lit(None).cast("long")

    rows = []
    for a, b in column_map.items():
        before = F.col(f"_m{src.index(a)}") if a in src else absent
        after = F.col(f"_t._m{dst.index(b)}") if b in dst else absent
        rows.append((F.lit(a), F.lit(b), before, after, after - before))
    names = [
        f"{source_name}_column",
        f"{target_name}_column",
        f"{source_name}_null_count",
        f"{target_name}_null_count",
        "null_count_change",
    ]
    return spread(both, names, rows)


def residual_gaps(
    df: DataFrame,
    issues: Mapping[str, Column],
) -> DataFrame:
    """Rows still affected by each named issue, and their share."""
    named = list(issues.items())
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(flag).alias(f"_i{i}") for i, (_, flag) in enumerate(named)],
    )
    rows = [
        (F.lit(name), F.col(f"_i{i}"), percent(F.col(f"_i{i}"), F.col("_rows")))
        for i, (name, _) in enumerate(named)
    ]
    return spread(counts, ["issue", "rows_affected", "pct"], rows)
