"""Quality reports on the re-engineered transaction frame (``plans.transactions``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.datetimes import datetime_status
from mendwork.functions.fixed_values import DUPLICATED_ID_ISSUE, ISSUE_LABELS
from mendwork.functions.mapping import canonical, is_unmapped
from mendwork.functions.nulls import NullPolicy, is_missing_text
from mendwork.functions.numeric import to_number
from mendwork.functions.text import strip
from mendwork.operators.accuracy import amount_status
from mendwork.operators.duplicates import duplicated_rows_by_key, key_uniqueness
from mendwork.operators.report import spread


CATEGORIES = ("status", "card_type", "city")


def _snapshot_counters(categories: Sequence[str]) -> dict[str, Column]:
    """The counts that a snapshot is made of; those of parts of a table add up."""

    def blank(c: str) -> Column:
        return is_missing_text(F.col(c), NullPolicy.BLANK)

    amount = to_number(F.col("amount"), None)
    raw_text = amount.isNull() & ~blank("amount")
    bad_amount = raw_text | F.coalesce(amount < 0, F.lit(False)) | F.col("amount_outlier_flag")
    counters = {"rows": F.count("*")}
    for c in categories:
        counters[f"{c}_null"] = F.count_if(blank(c))
        counters[f"{c}_bad"] = F.count_if(F.col(f"{c}_invalid_flag"))
        counters[f"{c}_good"] = F.count(f"{c}_clean")
    counters["time_null"] = F.count_if(blank("time"))
    counters["time_bad"] = F.count_if("time_invalid_flag")
    counters["time_good"] = F.count_if("time_valid_flag")
    counters["amount_null"] = F.count_if(blank("amount"))
    counters["amount_bad"] = F.count_if(bad_amount)
    counters["amount_text"] = F.count_if("amount_non_numeric_flag")
    counters["amount_good"] = F.count("amount_clean")
    return counters


def _snapshot_report(one: DataFrame, categories: Sequence[str]) -> DataFrame:
    """The report from one row of counts."""
    n = F.col("rows")

    def category(c: str) -> tuple[Column, ...]:
        null, bad, good = F.col(f"{c}_null"), F.col(f"{c}_bad"), F.col(f"{c}_good")
        return F.lit(c), n - null - bad, bad, null, good, bad, n - good - bad

    def time() -> tuple[Column, ...]:
        good = F.col("time_good")
        return (
            F.lit("time"), good, F.col("time_bad"), F.col("time_null"),
            good, F.lit(0).cast("long"), n - good,
        )

    def money() -> tuple[Column, ...]:
        null, bad = F.col("amount_null"), F.col("amount_bad")
        good, text = F.col("amount_good"), F.col("amount_text")
        return F.lit("amount"), n - null - bad, bad, null, good, text, n - good - text

    names = [
        "column", "before_valid", "before_invalid", "before_null",
        "after_valid", "after_invalid", "after_null",
    ]
    return spread(one, names, [*[category(c) for c in categories], time(), money()])


def quality_snapshot(df: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Valid / invalid / null per column, before and after cleaning.

    "Before" looks at the columns as the cleansing left them. A time without a
    standard form is null afterwards, never invalid.
    """
    one = df.agg(*[c.alias(n) for n, c in _snapshot_counters(categories).items()])
    return _snapshot_report(one, categories)


def snapshot_states(df: DataFrame, day: Column, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """(day, counts): what each day adds to the snapshot; rows without a day are a day of their own (NULL)."""
    staged = df.withColumn("_day", day.cast("date"))
    return staged.groupBy(F.col("_day").alias("day")).agg(*[c.alias(n) for n, c in _snapshot_counters(categories).items()])


def store_states(states: DataFrame, folder: str) -> None:
    """Write the states, one partition per day. Days that are stored already are replaced, others stay.

    So a new day costs the scan of its own rows, and a day that is written again counts once.
    """
    states.repartition("day").write.mode("overwrite").partitionBy("day").option("partitionOverwriteMode", "dynamic").parquet(folder)


def merged_snapshot(states: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """The snapshot of all rows that the states stand for, without reading them."""
    names = [c for c in states.columns if c != "day"]
    return _snapshot_report(states.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]), categories)


def snapshot_against(df: DataFrame, baseline: DataFrame, mappings: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """The snapshot with "before" taken from the raw table instead."""
    after = quality_snapshot(df, list(mappings))
    amount = F.col("amount")
    states = {
        c: (
            is_missing_text(F.col(c), NullPolicy.BLANK),
            is_unmapped(F.col(c), canonical(F.col(c), m)),
        )
        for c, m in mappings.items()
    }
    states["time"] = (
        is_missing_text(F.col("time"), NullPolicy.BLANK),
        datetime_status(F.col("time")).isin("invalid", "impossible_date_or_time"),
    )
    states["amount"] = (
        is_missing_text(amount, NullPolicy.BLANK),
        ~is_missing_text(amount, NullPolicy.BLANK)
        & F.coalesce(to_number(amount, None) < 0, F.lit(True)),
    )
    counters = [F.count("*").alias("_rows")]
    for c, (null, bad) in states.items():
        counters += [F.count_if(null).alias(f"{c}_null"), F.count_if(bad).alias(f"{c}_bad")]
    rows = [
        (
            F.lit(c),
            F.col("_rows") - F.col(f"{c}_null") - F.col(f"{c}_bad"),
            F.col(f"{c}_bad"),
            F.col(f"{c}_null"),
        )
        for c in states
    ]
    names = ["column", "before_valid", "before_invalid", "before_null"]
    before = spread(baseline.agg(*counters), names, rows)
    return before.join(after.select("column", "after_valid", "after_invalid", "after_null"), "column")


def issue_counts(df: DataFrame, id_column: str = "id") -> DataFrame:
    """The eight issue counts of the re-engineered frame."""
    counts = df.agg(*[F.count_if(flag).alias(flag) for _, _, flag in ISSUE_LABELS]).withColumn(
        "duplicated", duplicated_rows_by_key(df, id_column).scalar()
    )
    rows = [(F.lit(c), F.lit(text), F.col(flag)) for c, text, flag in ISSUE_LABELS]
    rows.append((F.lit(id_column), F.lit(DUPLICATED_ID_ISSUE), F.col("duplicated")))
    return spread(counts, ["column", "issue", "row_count"], rows)


def affected_cells(issues: DataFrame) -> DataFrame:
    """All issue counts added up."""
    return issues.agg(F.sum("row_count").alias("affected_cells"))


def invalid_time_rows(df: DataFrame) -> DataFrame:
    """Rows whose time was there but did not parse, with their keys."""
    keys = [c for c in ("transaction_id", "id", "time") if c in df.columns]
    return df.filter("time_invalid_flag").select(*keys)


def scorecard(
    df: DataFrame,
    key: str,
    domains: Mapping[str, Sequence[str]],
    amount: str = "amount",
    time: str = "time",
    valid: Column | None = None,
) -> DataFrame:
    """Five ratios in percent and their mean: our own formula, since none is published.

    completeness: cells that are not null-like; consistency: present values in
    canonical spelling; accuracy: amounts above zero; uniqueness: distinct keys per
    row; validity: times that are a real moment in an accepted layout, or what ``valid``
    says where a table holds date and clock apart.
    """
    if valid is None:
        valid = datetime_status(F.col(time)) == "valid"
    rows = F.count("*")
    missing = sum(
        (F.count_if(is_missing_text(F.col(c).cast("string"))) for c in df.columns[1:]),
        F.count_if(is_missing_text(F.col(df.columns[0]).cast("string"))),
    )
    present, proper = [], []
    for c, canon in domains.items():
        text = strip(F.col(c))
        present.append(F.count_if(text != ""))
        proper.append(F.count_if(text.isin(*canon)))
    one = df.agg(
        rows.alias("_rows"),
        missing.alias("_missing"),
        sum(present[1:], present[0]).alias("_present"),
        sum(proper[1:], proper[0]).alias("_proper"),
        F.count_if(amount_status(F.col(amount)) == "valid").alias("_amount"),
        F.count_if(valid).alias("_time"),
    ).withColumn("_keys", key_uniqueness(df, key).select("distinct_values").scalar())

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))

    total = F.col("_rows")
    cells = total * len(df.columns)
    scores = one.select(
        share(cells - F.col("_missing"), cells).alias("completeness"),
        share(F.col("_proper"), F.col("_present")).alias("consistency"),
        share(F.col("_amount"), total).alias("accuracy"),
        share(F.col("_keys"), total).alias("uniqueness"),
        share(F.col("_time"), total).alias("validity"),
    )
    names = scores.columns
    mean = sum((F.col(c) for c in names[1:]), F.col(names[0])) / len(names)
    lines = [(F.lit(c), F.round(F.col(c), 2)) for c in names]
    return spread(scores, ["dimension", "score"], [*lines, (F.lit("overall"), F.round(mean, 2))])


def scorecard_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two scorecards side by side with the change per dimension."""
    old = before.select("dimension", F.col("score").alias("before"))
    new = after.select("dimension", F.col("score").alias("after"))
    change = F.round(F.col("after") - F.col("before"), 2).alias("change")
    return old.join(new, "dimension").select("dimension", "before", "after", change)
