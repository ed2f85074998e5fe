"""Repeated ids and repeated rows.

Every operator aggregates before it shuffles, so an id (or a row) that makes up a
third of the table is one counter per task; nothing is windowed per id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.fixed_values import DUPLICATE_ID_LABELS, DUPLICATE_ROW_LABELS
from mendwork.functions.numeric import percent
from mendwork.functions.text import strip
from mendwork.operators.report import spread
from mendwork.session import materialise


def _id_text(df: DataFrame, column: str) -> Column:
    return strip(F.col(column).cast("string"))


def id_counts(df: DataFrame, column: str, count_name: str = "duplicate_count") -> DataFrame:
    """Rows per id, null and blank ids left out."""
    ids = df.select(_id_text(df, column).alias(column)).filter(F.col(column) != "")
    return ids.groupBy(column).agg(F.count("*").alias(count_name))


def duplicate_id_summary(df: DataFrame, column: str) -> DataFrame:
    """Rows, null ids, non-null ids, rows with a repeated id, and their rate."""
    # NULL and blank ids form one group here and are told apart by the key.
    ids = df.select(F.coalesce(_id_text(df, column), F.lit("")).alias("_id"))
    counts = ids.groupBy("_id").agg(F.count("*").alias("_n"))
    present = F.col("_id") != ""
    totals = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("_n"))), F.lit(0)).alias("_null"),
        F.coalesce(F.sum(F.when(present, F.col("_n"))), F.lit(0)).alias("_ids"),
        F.coalesce(F.sum(F.when(present & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("_dup"),
    )
    rows = [
        (DUPLICATE_ID_LABELS["rows"], F.col("_rows").cast("double")),
        (DUPLICATE_ID_LABELS["null"], F.col("_null").cast("double")),
        (DUPLICATE_ID_LABELS["ids"], F.col("_ids").cast("double")),
        (DUPLICATE_ID_LABELS["repeated"], F.col("_dup").cast("double")),
        (DUPLICATE_ID_LABELS["rate"], percent(F.col("_dup"), F.col("_ids"))),
    ]
    return spread(totals, ["metric", "value"], [(F.lit(n), c) for n, c in rows])


def repeated_ids(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Ids that occur more than once, most frequent first."""
    repeated = id_counts(df, column).filter(F.col("duplicate_count") > 1)
    ordered = repeated.orderBy(F.desc("duplicate_count"), F.asc(column))
    return ordered.limit(top) if top else ordered


def id_value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Number of id values that occur once, and more than once."""
    return id_counts(df, column, "_n").agg(
        F.count_if(F.col("_n") == 1).alias("unique_id_values"),
        F.count_if(F.col("_n") > 1).alias("duplicated_id_values"),
    )


def duplicated_rows_by_key(df: DataFrame, column: str) -> DataFrame:
    """One row: rows whose key occurs again, with NULL counted as a key of its own."""
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    repeated = F.sum(F.when(F.col("_n") > 1, F.col("_n")))
    return counts.agg(F.coalesce(repeated, F.lit(0)).alias("duplicated_rows"))


def _row_hash(columns: Sequence[str]) -> Column:
    # NULLs are skipped by the hash, so a null mask keeps (a, NULL) and (NULL, a) apart.
    mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*[F.col(c) for c in columns], mask)


def _candidates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose 64-bit hash occurs again: all true repeats and a few others.

    Only hashes are counted over the whole table. The repeated ones are written, so
    that Spark broadcasts them if they are few and full rows move for the candidates
    alone.
    """
    hashed = df.withColumn("_h", _row_hash(columns))
    repeated = hashed.groupBy("_h").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    return hashed.join(materialise(repeated.select("_h"), "hashes"), "_h", "left_semi")


def duplicate_row_groups(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fully identical rows (NULL equals NULL) with the size of each group."""
    columns = list(columns or df.columns)
    groups = _candidates(df.select(*columns), columns).groupBy(*columns)
    return groups.agg(F.count("*").alias("duplicate_count")).filter(F.col("duplicate_count") > 1)


def duplicate_row_members(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``df`` that have an identical twin on ``columns``."""
    columns = list(columns or df.columns)
    # The candidates are few; written once, they serve as rows and as groups.
    candidates = materialise(_candidates(df, columns), "candidates")
    counts = candidates.groupBy(*columns).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    groups = counts.select(*[F.col(c).alias(f"_g_{c}") for c in columns])
    match = [candidates[c].eqNullSafe(groups[f"_g_{c}"]) for c in columns]
    return candidates.join(groups, match, "left_semi").select(*df.columns)


def duplicate_row_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, rows in groups of identical rows, and number of such groups."""
    groups = duplicate_row_groups(df, columns)
    totals = groups.agg(
        F.coalesce(F.sum("duplicate_count"), F.lit(0)).alias("_members"),
        F.count("*").alias("_groups"),
    ).withColumn("_rows", df.agg(F.count("*")).scalar())
    rows = [
        (F.lit(DUPLICATE_ROW_LABELS["rows"]), F.col("_rows")),
        (F.lit(DUPLICATE_ROW_LABELS["members"]), F.col("_members")),
        (F.lit(DUPLICATE_ROW_LABELS["groups"]), F.col("_groups")),
    ]
    return spread(totals, ["metric", "value"], rows)


def key_uniqueness(df: DataFrame, column: str) -> DataFrame:
    """Rows, distinct non-null keys, and rows whose key occurs again."""
    counts = df.groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("_n"))
    present = F.col("_k").isNotNull()
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count_if(present).alias("distinct_values"),
        F.coalesce(F.sum(F.when(present & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias(
            "duplicate_rows"
        ),
    )
