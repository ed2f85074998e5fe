"""Comma-separated files: quoted cells, cells with line breaks, short rows, rows with too many cells.

A quote inside a quoted cell is doubled. A row with fewer cells than the header lacks its last ones. A row with more
cells, or with a quoted cell that never ends, can't be read: such rows stop the read, or are parted from the
others with their text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mendwork.session import materialise

# One way to write and to read quotes and blanks, for all files of this library.
QUOTING = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
RECORD, FILE, FIELDS, PROBLEM = "_record", "_file", "_fields", "_problem"
TOO_MANY, OPEN_QUOTE = "too many fields", "quote without end"


@dataclass(frozen=True)
class Parted:
    """Readable rows as text, and unreadable ones: file, row_text, n_fields, expected_fields, problem."""

    rows: DataFrame
    quarantine: DataFrame


def _separator(options: dict[str, str]) -> str:
    lowered = {k.lower(): v for k, v in options.items()}
    return lowered.get("sep", lowered.get("delimiter", ","))


def _without_quoted(record: Column, sep: str) -> Column:
    """The record with its complete quoted cells emptied, so that separators and quotes left are real ones."""
    s = re.escape(sep)
    return F.regexp_replace(record, f'(^|{s})"(?:[^"]|"")*"(?={s}|\\r?\\n?\\z)', "$1")


def parse(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, columns: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """All rows as text, with the columns _file, _fields and _problem (NULL for a readable row).

    Cells that a short row lacks are NULL, empty cells are empty texts. With ``multi_line`` a cell may hold line
    breaks and each file is read by one task; without it large files are split. Files without a header need ``columns``.
    """
    form = QUOTING | {"multiLine": str(multi_line).lower(), "header": str(not columns).lower()} | options
    names = list(columns) if columns else spark.read.options(**form).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, RECORD]])
    # Only a row whose number of cells is not the header's has a record.
    read = spark.read.options(**form, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, enforceSchema="false").schema(schema).csv(path)
    sep = _separator(options)
    left = _without_quoted(F.col(RECORD), sep)
    fields = F.when(F.col(RECORD).isNull(), len(names)).otherwise(F.size(F.split(left, re.escape(sep))))
    problem = F.when(left.rlike(f'(?:^|{re.escape(sep)})"'), OPEN_QUOTE).when(fields > len(names), TOO_MANY)
    marked = read.select("*", F.input_file_name().alias(FILE), fields.alias(FIELDS), F.when(F.col(RECORD).isNotNull(), problem).alias(PROBLEM))
    cells = [F.when(F.col(FIELDS) > i, F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for i, c in enumerate(names)]
    return marked.select(*cells, RECORD, FILE, FIELDS, PROBLEM)


def _cells(parsed: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in parsed.columns if c not in (RECORD, FILE, FIELDS, PROBLEM)]


def read_strict(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, columns: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """All rows as text; a row that can't be read stops the job that meets it."""
    parsed = parse(spark, path, multi_line, columns, **options)
    said = F.concat(F.lit("unreadable row in "), F.col(FILE), F.lit(": "), F.col(PROBLEM), F.lit(": "), F.substring(RECORD, 1, 200))
    readable = F.when(F.col(PROBLEM).isNull(), True).otherwise(F.raise_error(said).cast("boolean"))
    # A plain count has to parse a cell too: Spark refuses to read the record column alone.
    cells = _cells(parsed)
    return parsed.where((F.length(F.coalesce(cells[0], F.lit(""))) >= 0) & readable).select(*cells)


def read_parted(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, columns: Sequence[str] | None = None, **options: str
) -> Parted:
    """Readable and unreadable rows. The files are parsed once: both parts are read from what that wrote."""
    parsed = materialise(parse(spark, path, multi_line, columns, **options), "parsed")
    cells = _cells(parsed)
    bad = parsed.where(F.col(PROBLEM).isNotNull()).select(
        F.col(FILE).alias("file"),
        F.col(RECORD).alias("row_text"),
        F.col(FIELDS).alias("n_fields"),
        F.lit(len(cells)).alias("expected_fields"),
        F.col(PROBLEM).alias("problem"),
    )
    return Parted(parsed.where(F.col(PROBLEM).isNull()).select(*cells), bad)


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One file per partition, each with a header; blanks, quotes and line breaks in texts are kept, NULL is an empty cell."""
    df.write.mode(mode).options(**QUOTING, emptyValue="").csv(path)
