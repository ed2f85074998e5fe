"""Canonical values of columns, and checks against the canon."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.fixed_values import NULL_TOKEN
from mendwork.functions.mapping import canonical, is_unmapped
from mendwork.functions.numeric import percent
from mendwork.functions.text import snake_case, strip
from mendwork.operators.consistency import distinct_values
from mendwork.operators.report import spread
from mendwork.operators.star import require_unique


def canonicalise(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str],
    out: str | None = None,
    flag: str | None = None,
    stripped: bool = False,
) -> DataFrame:
    """Add the canonical value, and a flag for values that have none."""
    out, flag = out or f"{column}_clean", flag or f"{column}_invalid_flag"
    staged = df.withColumn(out, canonical(F.col(column), mapping, stripped))
    return staged.withColumn(flag, is_unmapped(F.col(column), F.col(out), stripped))


def canonicalise_by_table(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    key: str = "variant",
    value: str = "canonical",
    out: str | None = None,
    flag: str | None = None,
) -> DataFrame:
    """The same with the mapping held in a table with a lower-case ``key``; a repeated key is an error.

    No broadcast hint: the table may grow, so AQE decides by its measured size and
    splits a spelling that most rows share if it has to shuffle.
    """
    out, flag = out or f"{column}_clean", flag or f"{column}_invalid_flag"
    require_unique(lookup, key)
    table = lookup.select(F.col(key).alias("_key"), F.col(value).alias(out))
    joined = df.join(table, F.lower(strip(F.col(column))) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(flag, is_unmapped(F.col(column), F.col(out)))


def lookup_report(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str],
    dimension: DataFrame,
    name: str,
    id_name: str,
) -> DataFrame:
    """Per distinct raw value: its canonical name and dimension id, NULL token if unknown."""
    raw = distinct_values(df, column, f"raw_{column}")
    named = raw.withColumn("_canon", canonical(F.col(f"raw_{column}"), mapping))
    ids = dimension.select(F.col(name).alias("_canon"), F.col(id_name).alias("_id"))
    token = F.lit(NULL_TOKEN)
    return named.join(ids, "_canon", "left").select(
        f"raw_{column}",
        F.coalesce("_canon", token).alias(f"canonical_{column}"),
        F.coalesce("_id", token).alias(id_name),
    )


def _spellings(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    raw = strip(F.col(column))
    return (
        df.select(raw.alias("raw_value"))
        .filter("raw_value IS NOT NULL AND raw_value <> ''")
        .groupBy("raw_value")
        .agg(F.count("*").alias("row_count"))
        .withColumn("canonical", canonical(F.col("raw_value"), mapping))
    )


def reconcile_mapping(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Rows per spelling next to the total of its canonical value.

    The totals are joined back rather than windowed: unmapped spellings form one
    group that may be very large.
    """
    spelled = _spellings(df, column, mapping)
    totals = spelled.groupBy(F.col("canonical").alias("_c")).agg(
        F.sum("row_count").alias("canonical_count")
    )
    joined = spelled.join(totals, spelled["canonical"].eqNullSafe(totals["_c"]))
    share = percent(F.col("row_count"), F.col("canonical_count"))
    return joined.select(
        "canonical", "raw_value", "row_count", "canonical_count", share.alias("pct_of_canonical")
    )


def _with_gaps(text: Column, distance: int) -> Column:
    """The text and all texts that arise by leaving out up to ``distance`` characters."""
    grown = F.array(text)
    for _ in range(distance):
        shorter = F.flatten(F.transform(grown, lambda t: F.transform(
            F.sequence(F.lit(1), F.greatest(F.char_length(t), F.lit(1))),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t))),
        )))
        grown = F.array_distinct(F.concat(grown, shorter))
    return grown


def propose_mapping(df: DataFrame, column: str, mapping: Mapping[str, str], distance: int = 1) -> DataFrame:
    """(raw_value, row_count, proposed, distance, n_proposals): canonical values for spellings that the mapping lacks.

    A spelling is proposed for the canonical value with a known spelling (or name) at the smallest edit distance, up to
    ``distance``; where several values are equally close the smallest is named and ``n_proposals`` says how many
    there are. Two texts within that distance share a text that arises by leaving out characters, so candidates
    come from an equality join of such texts, and only they are measured. Spellings without a proposal are not listed.
    """
    unknown = _spellings(df, column, mapping).filter("canonical IS NULL").select("raw_value", "row_count", F.lower("raw_value").alias("_raw"))
    known = {(k.lower(), v) for k, v in mapping.items()} | {(v.lower(), v) for v in mapping.values()}
    spelled = df.sparkSession.createDataFrame(sorted(known), "_known string, _name string")
    left = unknown.select("*", F.explode(_with_gaps(F.col("_raw"), distance)).alias("_gapped"))
    right = spelled.select("*", F.explode(_with_gaps(F.col("_known"), distance)).alias("_gapped"))
    pairs = left.join(right, "_gapped").select("raw_value", "row_count", "_raw", "_known", "_name").distinct()
    near = pairs.withColumn("_distance", F.levenshtein("_raw", "_known")).filter(F.col("_distance") <= distance)
    by_name = near.groupBy("raw_value", "row_count", "_name").agg(F.min("_distance").alias("_distance"))
    # At most as many entries as there are canonical values.
    best = by_name.groupBy("raw_value", "row_count").agg(F.sort_array(F.collect_list(F.struct("_distance", "_name"))).alias("_all"))
    first = F.get("_all", F.lit(0))
    same = F.size(F.filter("_all", lambda x: x["_distance"] == F.col("_all")[0]["_distance"]))
    return best.select(
        "raw_value", "row_count", first["_name"].alias("proposed"), first["_distance"].alias("distance"), same.alias("n_proposals")
    )


def fragmentation(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Per canonical value: spellings, true total, rows spelled exactly so, undercount."""
    spelled = _spellings(df, column, mapping).filter("canonical IS NOT NULL")
    exact = F.sum(F.when(F.col("raw_value") == F.col("canonical"), F.col("row_count")))
    grouped = spelled.groupBy("canonical").agg(
        F.count("*").alias("variants"),
        F.sum("row_count").alias("canonical_count"),
        F.coalesce(exact, F.lit(0)).alias("exact_count"),
    )
    missed = F.col("canonical_count") - F.col("exact_count")
    return grouped.withColumn("undercount_pct", percent(missed, F.col("exact_count")))


def domain_compliance(df: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per column: rows with a value outside the canon (exact spelling), and compliance."""
    named = list(columns.items())

    def outside(column: str, canon: Sequence[str]) -> Column:
        text = strip(F.col(column))
        return F.coalesce((text != "") & ~text.isin(*canon), F.lit(False))

    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(outside(c, canon)).alias(f"_o{i}") for i, (c, canon) in enumerate(named)],
    )
    rows = [
        (
            F.lit(c),
            F.col("_rows"),
            F.col(f"_o{i}"),
            percent(F.col(f"_o{i}"), F.col("_rows")),
            percent(F.col("_rows") - F.col(f"_o{i}"), F.col("_rows")),
        )
        for i, (c, _) in enumerate(named)
    ]
    names = ["column", "total_rows", "non_canonical_rows", "non_canonical_pct", "compliance_pct"]
    return spread(counts, names, rows)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def constant_columns(df: DataFrame) -> DataFrame:
    """(column, value) of columns that hold a single value in every row."""
    ends = [
        end
        for i, c in enumerate(df.columns)
        for end in (
            F.min(c).cast("string").alias(f"_lo{i}"),
            F.max(c).cast("string").alias(f"_hi{i}"),
            F.count(c).alias(f"_n{i}"),
        )
    ]
    counts = df.agg(F.count("*").alias("_rows"), *ends)
    rows = []
    for i, c in enumerate(df.columns):
        same = (F.col(f"_lo{i}") == F.col(f"_hi{i}")) & (F.col(f"_n{i}") == F.col("_rows"))
        rows.append((F.lit(c), F.when(same, F.col(f"_lo{i}"))))
    return spread(counts, ["column", "value"], rows).filter("value IS NOT NULL")


def drop_constant_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table without its constant columns, and the values they had.

    The schema depends on the data, so one aggregate is run to find the columns.
    """
    constants = {r["column"]: r["value"] for r in constant_columns(df).collect()}
    return df.drop(*constants), constants


def range_label_check(
    df: DataFrame, value: str, label: str, bands: Sequence[tuple[float | None, str]]
) -> DataFrame:
    """Compare a stored label with the band its value falls in.

    ``bands`` lists (upper bound, exclusive, label) in order; the last bound is None.
    """
    x, expected = F.col(value), None
    for upper, name in bands:
        if upper is None:
            expected = (
                expected.otherwise(name) if expected is not None else F.lit(name)
            )
        else:
            condition = x < upper
            expected = (
                expected.when(condition, name) if expected is not None else F.when(condition, name)
            )
    expected = F.when(x.isNotNull(), expected)
    return df.withColumn("expected_label", expected).withColumn(
        "label_matches", F.col(label).eqNullSafe(F.col("expected_label"))
    )
