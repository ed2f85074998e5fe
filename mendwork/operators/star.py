"""Splitting a wide table into facts, dimensions and column groups, and checking the keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from mendwork.operators.keys import add_surrogate_key, with_row_rank


@dataclass(frozen=True)
class Dimension:
    """``name`` and ``id`` columns of a lookup table; ``fixed`` if its size is that of a
    mapping written in code, so that it may be broadcast without a check; ``unique`` if no
    name can occur twice, which is checked otherwise."""

    table: DataFrame
    name: str
    id: str
    fixed: bool = False
    unique: bool = False


def require_unique(df: DataFrame, column: str) -> None:
    """Raise if a key of a lookup repeats: a join with it would multiply rows."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1").first()
    if repeated is not None:
        raise ValueError(f"{column} is no key: {repeated[0]!r} occurs {repeated[1]} times")


def extract_dimension(
    df: DataFrame, column: str, id_name: str, prefix: str, name: str | None = None
) -> Dimension:
    """Distinct non-null values with ids in alphabetical order (``city_1``, ``city_2``, …)."""
    name = name or column
    values = df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()
    ranked = with_row_rank(values, [name], "_rank")
    ids = F.concat(F.lit(prefix), F.col("_rank").cast("string")).alias(id_name)
    return Dimension(ranked.select(ids, name), name, id_name, unique=True)


def dimension_of_values(
    spark: SparkSession, values: Iterable[str], name: str, id_name: str, prefix: str
) -> Dimension:
    """The dimension of a fixed set of canonical values."""
    rows = [(f"{prefix}{i}", v) for i, v in enumerate(sorted(set(values)), start=1)]
    table = spark.createDataFrame(rows, f"`{id_name}` string, `{name}` string")
    return Dimension(table, name, id_name, fixed=True, unique=True)


def star_fact(df: DataFrame, dimensions: Mapping[str, Dimension]) -> DataFrame:
    """Replace the named columns by dimension ids; NULL stays NULL. Repeated names are an error."""
    fact = df
    for column, dim in dimensions.items():
        if not dim.unique:
            require_unique(dim.table, dim.name)
        ids = dim.table.select(F.col(dim.name).alias("_name"), F.col(dim.id).alias("_id"))
        ids = F.broadcast(ids) if dim.fixed else ids
        fact = fact.join(ids, fact[column] == ids["_name"], "left").drop("_name")
        kept = [dim.id if c == column else c for c in fact.columns if c != "_id"]
        fact = fact.withColumn(dim.id, F.col("_id")).select(*dict.fromkeys(kept))
    return fact


def star_schema(
    df: DataFrame,
    dimensions: Mapping[str, str],
    order_by: Sequence[str],
    key: str = "row_id",
) -> dict[str, DataFrame]:
    """``dim_<column>`` tables with ids, and ``fact_sales`` with a surrogate key.

    ``dimensions`` maps a column to the name of its id.
    """
    dims = {c: extract_dimension(df, c, i, f"{c}_") for c, i in dimensions.items()}
    keyed = add_surrogate_key(df, order_by, key, pattern=None)
    fact = star_fact(keyed, dims)
    rest = [c for c in fact.columns if c != key]
    tables = {f"dim_{c}": dim.table for c, dim in dims.items()}
    return {"fact_sales": fact.select(key, *rest), **tables}


def vertical_split(
    df: DataFrame, key: str, groups: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Several tables of the same rows that share ``key``."""
    return {name: df.select(key, *columns) for name, columns in groups.items()}


def referential_integrity(
    checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Per (name, fact, foreign key, dimension, key): orphan keys and orphan rows.

    Keys are counted before the anti join, so the fact rows themselves never move.
    """
    reports = []
    for name, fact, fk, dim, pk in checks:
        keys = fact.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(
            F.count("*").alias("_n")
        )
        known = dim.select(F.col(pk).alias("_k")).distinct()
        marked = keys.join(known.withColumn("_known", F.lit(True)), "_k", "left")
        orphan = F.col("_known").isNull()
        reports.append(
            marked.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"),
                F.count_if(orphan).alias("orphan_keys"),
                F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(name).alias("foreign_key"), "*")
        )
    stacked = reports[0]
    for report in reports[1:]:
        stacked = stacked.unionByName(report)
    return stacked


def row_preservation(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row count of every stage."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages
    ]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked
