"""Reading tables as text, with the required columns checked on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from mendwork.functions.fixed_values import EXPECTED_COLUMNS
from mendwork.functions.nulls import NullPolicy, blank_to_null
from mendwork.sources import delimited


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any job runs if a column is absent; order and extra columns are free."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def require_id_column(df: DataFrame, column: str) -> DataFrame:
    """Fail with the id-like columns listed if the id column is absent."""
    if column not in df.columns:
        similar = [c for c in df.columns if "id" in c.lower()]
        raise ValueError(f"id column {column!r} not found; id-like columns: {similar}")
    return df


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text: dirty columns are parsed later, never inferred."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def apply_null_policy(df: DataFrame, policy: NullPolicy | None) -> DataFrame:
    """Texts that the policy calls missing become NULL (no policy: texts stay)."""
    if policy is None:
        return df
    text = {c for c, t in df.dtypes if t == "string"}
    return df.select(
        *[
            blank_to_null(F.col(f"`{c}`"), policy).alias(c) if c in text else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    required: Sequence[str] = (),
    policy: NullPolicy | None = NullPolicy.NA_TOKENS,
    **options: str,
) -> DataFrame:
    """Read csv, parquet, json or orc; CSV columns all come as text.

    Without a policy an empty CSV field is an empty text. A CSV row with too many fields stops the read;
    ``delimited.read_parted`` puts such rows aside.
    """
    df = delimited.read_strict(spark, path, **options) if fmt == "csv" else spark.read.format(fmt).options(**options).load(path)
    return apply_null_policy(require_columns(df, required), policy)


def load_transactions(
    spark: SparkSession, path: str, fmt: str = "csv", policy: NullPolicy | None = NullPolicy.NA_TOKENS
) -> DataFrame:
    return as_text(read_table(spark, path, fmt, EXPECTED_COLUMNS, policy))


def load_transactions_parted(spark: SparkSession, path: str, policy: NullPolicy | None = NullPolicy.NA_TOKENS) -> delimited.Parted:
    """Transactions from csv, and the rows that can't be read in a table of their own."""
    parted = delimited.read_parted(spark, path)
    return delimited.Parted(apply_null_policy(require_columns(parted.rows, EXPECTED_COLUMNS), policy), parted.quarantine)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A small CSV lookup such as (city_id, city)."""
    return read_table(spark, path, "csv")


def first_rows(df: DataFrame, order_by: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in order, for a trial run; all rows if ``n`` is None."""
    return df if n is None else df.orderBy(*order_by).limit(n)
