"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

# Rows that a Python worker handles at a time: bounds its memory, not the result.
SLICE = 1000


def ship(module_name: str) -> None:
    """Send the module's functions to the workers by value: no installation is needed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for memos that any task may fill.

    Memos only save time: a lost worker starts with an empty one.
    """
    holder = sys.modules.setdefault("_mendwork_llm_memos", types.ModuleType("_mendwork_llm_memos"))
    return holder.__dict__.setdefault(name, {})


def map_rows(
    df: DataFrame,
    work: Callable[[dict[str, list]], dict[str, list]],
    schema: str,
    slice_rows: int = SLICE,
) -> DataFrame:
    """Apply ``work`` to slices of rows given as lists by column name; it returns new lists."""
    target = arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                part = batch.slice(start, slice_rows)
                rows = {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
                out = work(rows)
                if out and len(next(iter(out.values()))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target
                    )

    return df.mapInArrow(run, schema)


def arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def utf8(column: str = "text") -> Column:
    """The text's UTF-8 bytes; a missing text counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")


# Bits of the table of hashed ids: 8 MB whatever the data, as 2,048 rows of 4 KB.
ID_BITS = 1 << 26


def split_by_ids(df: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key may be in ``ids`` (one column), and those whose key surely is not.

    A join with few ids would move all texts. Instead the ids' hashes are set in a bitmap of fixed size, the
    only thing that is broadcast; the first part has all rows of ``ids`` and a few others, and is joined as
    usual, the second one stays where it is. With very many ids the bitmap fills up and the first part has
    nearly all rows, which costs a shuffle but changes no result. Rows without a key are in the second part.
    """
    def spot(column: Column) -> Column:
        return F.pmod(F.xxhash64(column.cast("long")), F.lit(ID_BITS)) + 1

    name, bucket, bits = unused(df, "spot"), unused(df, "bucket"), unused(df, "bits")
    spots = ids.where(F.col(ids.columns[0]).isNotNull()).select(spot(F.col(ids.columns[0])).alias(name)).distinct()
    bitmap = spots.groupBy(F.bitmap_bucket_number(name).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias(bits))
    bitmap = materialise(bitmap, "id-bitmap")
    own = F.col(f"`{key}`").cast("long")
    position = F.bitmap_bit_position(spot(own))
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    # Bit n of a bitmap is bit n % 8 of byte n / 8.
    there = F.coalesce(_bit(byte, position % 8) == 1, F.lit(False)) & own.isNotNull()
    marked = df.withColumn(bucket, F.bitmap_bucket_number(spot(own))).join(F.broadcast(bitmap), bucket, "left")
    columns = [F.col(f"`{c}`") for c in df.columns]
    return marked.where(there).select(*columns), marked.where(~there).select(*columns)


def _bit(byte: Column, place: Column) -> Column:
    return F.floor(byte / F.pow(F.lit(2.0), place)).cast("long") % 2


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def is_fold(column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a missing id."""
    checksum = F.crc32(F.col(f"`{column}`").cast("string").cast("binary"))
    return F.coalesce(F.pmod(checksum, F.lit(modulus)) == remainder, F.lit(False))


def bounded_sample(df: DataFrame, key: str, bound: int, seed: int = 17, kind: str | None = None, least: int = 0) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the key: no sort, no single task.

    Used to fit classifiers only; everything is kept while there are no more rows than that. Of each value of
    the column ``kind`` about ``least`` rows are kept beyond that, or all if there are fewer.
    """
    rows = df.count()
    if rows <= bound:
        return df
    share = F.lit(int(bound / rows * (1 << 30)))
    if kind:
        # Only kinds with more rows than ``least`` come to the driver.
        many = df.groupBy(F.col(f"`{kind}`").alias("kind")).agg(F.count("*").alias("n")).where(F.col("n") > least).collect()
        share = F.lit(1 << 30)
        for r in many:
            share = F.when(F.col(f"`{kind}`").eqNullSafe(F.lit(r.kind)), int(max(bound / rows, least / r.n) * (1 << 30))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(1 << 30))
    return df.where(draw < share)
