"""Interquartile-range outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.numeric import to_number
from mendwork.functions.text import strip
from mendwork.operators.quantiles import exact_quantiles
from mendwork.operators.report import spread
from mendwork.session import materialise

POSITIVE_ABS = "positive_abs"
SIGNED = "signed"


def measured(number: Column, population: str) -> Column:
    """The value that is compared with the bounds."""
    return F.abs(number) if population == POSITIVE_ABS else number


def iqr_bounds(
    df: DataFrame,
    number: str | Column,
    population: str = POSITIVE_ABS,
    k: float = 1.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """n, q1, q3, iqr, lower and upper bound; one row, or one per group of ``by``.

    ``positive_abs`` takes the absolute values above zero, ``signed`` takes all.
    """
    x = measured(F.col(number) if isinstance(number, str) else number, population)
    above = 0.0 if population == POSITIVE_ABS else None
    # A plain column is read as it is; anything else is written once.
    q = exact_quantiles(df, x, [0.25, 0.75], by, above=above, write=not isinstance(number, str))
    spans = q.select(
        *by, "n", F.col("q0").alias("q1"), F.col("q1").alias("q3"), (F.col("q1") - F.col("q0")).alias("iqr")
    )
    return spans.select(
        "*",
        (F.col("q1") - k * F.col("iqr")).alias("lower"),
        (F.col("q3") + k * F.col("iqr")).alias("upper"),
    )


def with_outlier_flag(
    df: DataFrame,
    number: str | Column,
    flag: str = "outlier_flag",
    population: str = POSITIVE_ABS,
    k: float = 1.5,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Add a never-null flag.

    Runs the job for the bounds at once and puts the two numbers into the plan, so
    the rows are neither joined nor shuffled, and a second pass over the result does
    not carry the first pass's plan inside its own. Without a population nothing is
    flagged.
    """
    if bounds is None:
        bounds = iqr_bounds(df, number, population, k)
    number = F.col(number) if isinstance(number, str) else number
    lower, upper = bounds.select("lower", "upper").first()
    if lower is None:
        return df.withColumn(flag, F.lit(False))
    x = measured(number, population)
    return df.withColumn(flag, F.coalesce((x < lower) | (x > upper), F.lit(False)))


def null_outliers(
    df: DataFrame,
    column: str,
    passes: int = 1,
    population: str = POSITIVE_ABS,
) -> DataFrame:
    """Set outliers to NULL; with two passes the bounds are taken again on what is left."""
    kind = df.schema[column].dataType.simpleString()
    for _ in range(passes):
        number = to_number(F.col(column)) if kind == "string" else F.col(column)
        flagged = with_outlier_flag(df, number, "_outlier", population)
        df = flagged.withColumn(
            column, F.when(~F.col("_outlier"), F.col(column))
        ).drop("_outlier")
    return df


def iqr_report(
    df: DataFrame, number: str | Column, population: str = SIGNED
) -> DataFrame:
    """The bounds and the number of rows outside and inside them; the number is computed and written once."""
    number = F.col(number) if isinstance(number, str) else number
    staged = materialise(df.select(number.alias("_x")), "numbers")
    bounds = materialise(iqr_bounds(staged, "_x", population), "bounds")
    flagged = with_outlier_flag(staged, "_x", "_out", population, bounds=bounds)
    inside = ~F.col("_out") & F.col("_x").isNotNull()
    counts = flagged.agg(
        F.count_if("_out").alias("outlier_rows"), F.count_if(inside).alias("non_outlier_rows")
    )
    named = ["q1", "q3", "iqr", "lower", "upper"]
    both = counts.withColumn("_b", bounds.select(F.struct(*named)).scalar())
    return both.select(*[F.col(f"_b.{c}").alias(c) for c in named], "outlier_rows", "non_outlier_rows")


def outlier_samples(
    df: DataFrame,
    number: str | Column,
    order_by: Sequence[str],
    n: int = 50,
    population: str = SIGNED,
) -> DataFrame:
    flagged = with_outlier_flag(df, number, "_out", population)
    return flagged.filter("_out").drop("_out").orderBy(*order_by).limit(n)


def status_outlier_crosstab(
    df: DataFrame, column: str
) -> DataFrame:
    """Amount status by outlier status, every cell present, in one aggregate."""
    text = strip(F.col(column))
    # Written: the bounds' scans and the count read the parsed number, not the text.
    missing = F.coalesce(text == "", F.lit(True))
    staged = materialise(df.select(missing.alias("_missing"), to_number(text, stripped=True).alias("_x")), "numbers")
    flagged = with_outlier_flag(staged, "_x", "_out", POSITIVE_ABS)
    status = (
        F.when((F.abs("_x") > 0) & ~F.col("_out"), "valid")
        .when(F.col("_missing"), "NULL")
        .otherwise("invalid")
    )
    outlier = (
        F.when(F.col("_out"), "outlier")
        .when(F.col("_x").isNotNull(), "non_outlier")
        .otherwise("not_numeric_or_null")
    )
    classed = flagged.select(status.alias("_s"), outlier.alias("_o"))
    lines, columns = ["valid", "invalid", "NULL"], ["outlier", "non_outlier", "not_numeric_or_null"]
    cells = [
        F.count_if((F.col("_s") == s) & (F.col("_o") == o)).alias(f"_{s}_{o}")
        for s in lines
        for o in columns
    ]
    rows = [(F.lit(s), *[F.col(f"_{s}_{o}") for o in columns]) for s in lines]
    return spread(classed.agg(*cells), ["amount_status", *columns], rows)


def stratified_outliers(
    df: DataFrame,
    number: str,
    by: Sequence[str],
    flag: str = "outlier_flag",
    population: str = POSITIVE_ABS,
) -> DataFrame:
    """Flag against the bounds of the row's own segment (NULL is a segment too).

    The bounds are written first: small ones are broadcast, and with many segments
    AQE splits one that holds most of the rows.
    """
    bounds = materialise(iqr_bounds(df, number, population, by=by), "bounds")
    renamed = bounds.select(*[F.col(c).alias(f"_b_{c}") for c in by], "lower", "upper")
    match = [df[c].eqNullSafe(renamed[f"_b_{c}"]) for c in by]
    x = measured(F.col(number), population)
    outside = (x < F.col("lower")) | (x > F.col("upper"))
    joined = df.join(renamed, match, "left")
    return joined.withColumn(flag, F.coalesce(outside, F.lit(False))).select(*df.columns, flag)
