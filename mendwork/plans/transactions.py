"""Transactions: cleanse, transform, normalise, report.

Every phase is DataFrame to DataFrame and adds only row-local columns. The bounds of
the two outlier passes are found by jobs of their own that read the amount column
alone; the only shuffle of whole rows is that of the surrogate key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from mendwork.functions.datetimes import (
    MIN_YEAR,
    datetime_status,
    iso_clock,
    iso_day,
    iso_stamp,
    parse_salvaged,
    salvage_time_text,
    with_parsed_datetime,
)
from mendwork.functions.fixed_values import (
    CARD_MAP,
    CITY_MAP,
    DUPLICATE_ROW_LABELS,
    EXPECTED_COLUMNS,
    STATUS_MAP,
)
from mendwork.functions.nulls import NullPolicy, is_missing
from mendwork.functions.numeric import to_number
from mendwork.functions.text import strip
from mendwork.operators.accuracy import amount_status
from mendwork.operators.canonical import canonicalise
from mendwork.operators.duplicates import duplicate_row_summary, duplicated_rows_by_key
from mendwork.operators.keys import add_surrogate_key
from mendwork.operators.outliers import with_outlier_flag
from mendwork.operators.quality import issue_counts
from mendwork.operators.quantiles import exact_median
from mendwork.operators.report import spread
from mendwork.operators.star import Dimension, dimension_of_values, star_fact
from mendwork.session import materialise
from mendwork.sources.readers import require_columns
from mendwork.sources.sinks import transformed_frame

TEXT_COLUMNS = ("status", "time", "card_type", "city", "amount")


@dataclass(frozen=True)
class Options:
    """``order_by`` must identify a row: it defines the numbering of the surrogate key.

    ``passes`` is how often outliers are looked for: 2 takes the bounds again on the
    rows that survived the cleansing.
    """

    order_by: Sequence[str]
    max_year: int | None = None
    min_year: int = MIN_YEAR
    passes: int = 2
    status_map: Mapping[str, str] = field(default_factory=lambda: STATUS_MAP)
    card_map: Mapping[str, str] = field(default_factory=lambda: CARD_MAP)
    city_map: Mapping[str, str] = field(default_factory=lambda: CITY_MAP)


def strip_columns(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: strip(F.col(c).cast("string")) for c in columns})


def cleanse_time(df: DataFrame, options: Options) -> DataFrame:
    """Salvage the time texts of a stripped table: ``time_stamp`` and ``time_formatted_flag`` are added."""
    time = F.col("time")
    parsed = with_parsed_datetime(
        df, "time", "time_stamp", options.max_year, options.min_year, stripped=True
    )
    salvaged = parsed.withColumn(
        "_salvaged",
        salvage_time_text(time, options.max_year, options.min_year, F.col("time_stamp")),
    )
    changed = F.col("_salvaged") != F.coalesce(time, F.lit(""))
    return (
        salvaged.withColumn("time_formatted_flag", changed)
        .withColumn("time", F.col("_salvaged"))
        .drop("_salvaged")
    )


def parse_amount(df: DataFrame) -> DataFrame:
    """``amount_number`` of a stripped table."""
    return df.withColumn("amount_number", to_number(F.col("amount"), stripped=True))


def null_amount_outliers(df: DataFrame) -> DataFrame:
    """First outlier pass of a table with ``amount_number``; adds ``amount_nulled_flag``."""
    flagged = with_outlier_flag(df, "amount_number", "amount_nulled_flag")
    kept = ~F.col("amount_nulled_flag")
    return flagged.withColumns(
        {c: F.when(kept, F.col(c)) for c in ("amount", "amount_number")}
    )


def cleanse_amount(df: DataFrame) -> DataFrame:
    """Parse the amounts of a stripped table and null outliers."""
    return null_amount_outliers(parse_amount(df))


def cleanse(df: DataFrame, options: Options) -> DataFrame:
    """Strip, salvage time texts, and null amount outliers.

    Adds ``time_formatted_flag`` and ``amount_nulled_flag`` for the counts, and
    ``time_stamp`` and ``amount_number``, so that later phases need not parse again.
    """
    return cleanse_amount(cleanse_time(strip_columns(df), options))


def cleansing_counts(cleansed: DataFrame) -> DataFrame:
    """(metric, value) of the cleansing phase."""
    counts = cleansed.agg(
        F.count_if("time_formatted_flag").alias("time_column_formatted_rows"),
        F.count_if("amount_nulled_flag").alias("amount_outlier_nulled"),
    )
    return spread(counts, ["metric", "value"], [(F.lit(c), F.col(c)) for c in counts.columns])


def transform_time(df: DataFrame, options: Options) -> DataFrame:
    if "time_stamp" in df.columns:
        # The cleansing kept every text that parsed and put the salvaged ones in one layout.
        stamp = F.coalesce(F.col("time_stamp"), parse_salvaged(F.col("time")))
        parsed = df.withColumn("time_parsed", stamp).drop("time_stamp")
    else:
        parsed = with_parsed_datetime(
            df, "time", "time_parsed", options.max_year, options.min_year, stripped=True
        )
    valid = F.col("time_parsed").isNotNull()
    return parsed.withColumns(
        {"time_valid_flag": valid, "time_invalid_flag": ~valid & _present("time")}
    )


def _present(column: str) -> Column:
    """Neither NULL nor empty, for a column that is already stripped."""
    return F.coalesce(F.col(column) != "", F.lit(False))


def transform_amount(df: DataFrame, options: Options) -> DataFrame:
    """Flags, and ``amount_numeric``: the absolute value of whatever is a number."""
    if "amount_number" not in df.columns:
        df = df.withColumn("amount_number", to_number(F.col("amount"), stripped=True))
    number = F.col("amount_number")
    there = _present("amount")
    flagged = df.withColumns(
        {
            "amount_non_numeric_flag": number.isNull() & there,
            "amount_negative_flag": F.coalesce(number < 0, F.lit(False)),
            "amount_numeric": F.abs(number),
        }
    ).drop("amount_number")
    if options.passes < 2:
        return flagged.withColumn("amount_outlier_flag", F.lit(False))
    return with_outlier_flag(flagged, "amount_numeric", "amount_outlier_flag")


def transform(df: DataFrame, options: Options) -> DataFrame:
    """Canonical values, parsed time and numeric amount of a cleansed table, with flags."""
    for column, mapping in (
        ("status", options.status_map),
        ("card_type", options.card_map),
        ("city", options.city_map),
    ):
        df = canonicalise(df, column, mapping, stripped=True)
    return transform_amount(transform_time(df, options), options)


# Metric name and the frame's column that it counts; time_null counts blanks.
_FLAG_METRICS = (
    ("status_invalid_rows", "status_invalid_flag"),
    ("time_valid_rows", "time_valid_flag"),
    ("time_invalid_rows", "time_invalid_flag"),
    ("card_type_invalid_rows", "card_type_invalid_flag"),
    ("city_invalid_rows", "city_invalid_flag"),
    ("amount_non_numeric_rows", "amount_non_numeric_flag"),
    ("amount_negative_rows", "amount_negative_flag"),
    ("amount_outlier_rows", "amount_outlier_flag"),
)
_NULL_METRICS = (
    ("status_clean_null_rows", "status_clean"),
    ("card_type_clean_null_rows", "card_type_clean"),
    ("city_clean_null_rows", "city_clean"),
    ("amount_clean_null_rows", "amount_clean"),
)


def phase_counts(frame: DataFrame) -> DataFrame:
    """(metric, value) of every phase whose columns the frame has, in one aggregate."""
    counters = []
    for name, flag in (
        ("time_column_formatted_rows", "time_formatted_flag"),
        ("amount_outlier_nulled", "amount_nulled_flag"),
        *_FLAG_METRICS,
    ):
        if flag in frame.columns:
            counters.append(F.count_if(flag).alias(name))
    for name, column in _NULL_METRICS:
        if column in frame.columns:
            counters.append(F.count_if(F.col(column).isNull()).alias(name))
    counters.append(
        F.count_if(~_present("time")).alias("time_null_rows")
    )
    counts = frame.agg(*counters)
    return spread(counts, ["metric", "value"], [(F.lit(c), F.col(c)) for c in counts.columns])


def normalise_columns(df: DataFrame) -> DataFrame:
    """Date and clock texts, and the amount without outliers."""
    stamp = F.col("time_parsed")
    return df.withColumns(
        {
            "time_clean": iso_stamp(stamp),
            "date_clean": iso_day(stamp),
            "clock_time_clean": iso_clock(stamp),
            "amount_clean": F.when(~F.col("amount_outlier_flag"), F.col("amount_numeric")),
        }
    )


def normalise(df: DataFrame, options: Options) -> DataFrame:
    return _with_key(normalise_columns(df), options)


def _with_key(df: DataFrame, options: Options) -> DataFrame:
    return add_surrogate_key(df, options.order_by)


@dataclass(frozen=True)
class Reengineered:
    """Lazy results of one run; ``frame`` has all columns and flags."""

    frame: DataFrame
    summary: DataFrame
    issues: DataFrame

    @property
    def transformed(self) -> DataFrame:
        return transformed_frame(self.frame)


def after_cleansing(cleansed: DataFrame, options: Options) -> DataFrame:
    """Transform and normalise a table that is already cleansed."""
    return normalise(transform(cleansed, options), options)


def run(df: DataFrame, options: Options) -> Reengineered:
    """All phases. The reports read the frame before the key is added: they need no order.

    The source is read once: its stripped and parsed rows are written to the shared
    folder, and both outlier passes read the one numeric column of that table.
    """
    require_columns(df, EXPECTED_COLUMNS)
    parsed = materialise(parse_amount(cleanse_time(strip_columns(df), options)), "transactions")
    ready = normalise_columns(transform(null_amount_outliers(parsed), options))
    return Reengineered(
        frame=_with_key(ready, options),
        summary=phase_counts(ready),
        issues=issue_counts(ready),
    )


def card_dimension(df: DataFrame, options: Options) -> Dimension:
    return dimension_of_values(
        df.sparkSession, options.card_map.values(), "card_type", "card_id", "card_"
    )


def city_dimension(df: DataFrame, options: Options) -> Dimension:
    return dimension_of_values(
        df.sparkSession, options.city_map.values(), "city", "city_id", "city_"
    )


def star(frame: DataFrame, options: Options) -> dict[str, DataFrame]:
    """The seven-column fact with card and city ids, and both dimensions."""
    card, city = card_dimension(frame, options), city_dimension(frame, options)
    wide = transformed_frame(frame).drop("id")
    fact = star_fact(wide, {"card_type": card, "city": city})
    columns = ["transaction_id", "status", "date", "time", "card_id", "city_id", "amount"]
    return {"fact": fact.select(*columns), "card": card.table, "city": city.table}


def profile_document(df: DataFrame, id_column: str = "id") -> DataFrame:
    """One row: size, missing by column, repeats, and valid / invalid / null time and amount."""
    time, amount = datetime_status(F.col("time")), amount_status(F.col("amount"))
    policy = NullPolicy.NA_TOKENS
    pairs = [
        x
        for c in df.columns
        for x in (F.lit(c), F.count_if(is_missing(df, c, policy)))
    ]
    twins = duplicate_row_summary(df).filter(F.col("metric") == DUPLICATE_ROW_LABELS["members"]).select("value")
    one = df.agg(
        F.count("*").alias("rows"),
        F.create_map(*pairs).alias("missing_by_col"),
        F.count_if(time == "valid").alias("valid_time_rows"),
        F.count_if(time.isin("invalid", "impossible_date_or_time")).alias("invalid_time_rows"),
        F.count_if(time == "NULL").alias("null_time_rows"),
        F.count_if(amount == "valid").alias("valid_amount_rows"),
        F.count_if(amount == "invalid").alias("invalid_amount_rows"),
        F.count_if(amount == "NULL").alias("null_amount_rows"),
    )
    return one.select(
        "rows",
        F.lit(len(df.columns)).cast("long").alias("cols"),
        "missing_by_col",
        twins.scalar().alias("exact_duplicate_rows"),
        duplicated_rows_by_key(df, id_column).scalar().alias("duplicated_id_rows"),
        *[f"{state}_{c}_rows" for c in ("time", "amount") for state in ("valid", "invalid", "null")],
    )


def metadata_document(frame: DataFrame, notes: Sequence[str] = ()) -> DataFrame:
    """One row: how many values each transform touched, and free notes."""
    kept = F.when(F.col("amount_clean") > 0, F.col("amount_clean"))
    median = exact_median(frame, kept).select("median").scalar()
    valid = F.count_if("time_valid_flag")
    unmapped = [
        F.count_if(f"{c}_invalid_flag").alias(f"{c}_unmapped_non_null_to_null")
        for c in ("status", "card_type", "city")
    ]
    counts = frame.agg(
        *unmapped,
        valid.alias("time_parsed_valid_rows"),
        (F.count("*") - valid).alias("time_parsed_invalid_or_null_rows"),
        F.count_if(kept.isNull()).alias("amount_invalid_or_null_rows_imputed"),
    ).withColumn("amount_global_median_used", median)
    words = F.array(*[F.lit(n) for n in notes]).cast("array<string>")
    return counts.select(F.struct("*").alias("transforms"), words.alias("notes"))
