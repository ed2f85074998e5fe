"""Several tables published as one: readers see all tables of a run, or those of the run before.

Each run writes its tables into a folder of its own, and they are read back and counted there. Only then one line
per table goes into the manifest, all of a run's lines in one file that appears as a whole. Readers follow the manifest
and never look at folders, so a run that fails half-way leaves the former one as it was.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from mendwork.sources import delimited

MANIFEST = "run string, table string, format string, path string, columns string, row_count long, checksum string"


class Incomplete(Exception):
    """What lies in the folder is not what the manifest says."""


def _load(spark: SparkSession, path: str, fmt: str, columns: str) -> DataFrame:
    """A written table; its columns are those of the manifest, in text form for csv."""
    schema = StructType.fromDDL(columns) if columns else StructType()
    if fmt == "csv":
        return spark.read.schema(schema).options(**delimited.QUOTING, multiLine="true").csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def signature(df: DataFrame) -> Row:
    """(row_count, checksum): the checksum adds up a hash per row, so it depends on neither order nor partitions."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    total = F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return df.agg(F.count("*").alias("row_count"), total.alias("checksum")).first()


def publish(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """Write all tables as one run and return its name; names of runs sort by time.

    Csv tables hold texts, so their columns are cast to text; an empty text comes back as NULL.
    """
    if not tables:
        raise ValueError("nothing to publish")
    folder = folder.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    run = f"{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    lines = []
    for name, df in tables.items():
        path = f"{folder}/runs/{run}/{name}"
        if fmt == "csv":
            df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
            delimited.write(df, path, "error")
        else:
            df.write.format(fmt).save(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        lines.append((run, name, fmt, f"runs/{run}/{name}", columns, *signature(_load(spark, path, fmt, columns))))
    # One partition is one file, which Spark moves to its place when it is complete.
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return run


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per published table and run; none if nothing was published yet."""
    try:
        return spark.read.schema(MANIFEST).json(f"{folder.rstrip('/')}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def read_published(spark: SparkSession, folder: str, run: str | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """The tables of the latest run, or of the one named; ``verify`` counts them again."""
    lines = manifest(spark, folder)
    if run is None:
        run = lines.agg(F.max("run")).first()[0]
    # One row per table.
    chosen = lines.where(F.col("run") == run).collect() if run else []
    if not chosen:
        raise Incomplete(f"no published run in {folder}")
    tables = {r.table: _load(spark, f"{folder.rstrip('/')}/{r.path}", r.format, r.columns) for r in chosen}
    if verify:
        for r in chosen:
            found = signature(tables[r.table])
            if (found.row_count, found.checksum) != (r.row_count, r.checksum):
                raise Incomplete(f"table {r.table} of run {run} has {found.row_count} rows, the manifest says {r.row_count}, or other values")
    return tables
