"""Ids seen before, on a stream: the first row of an id goes on, later ones are put aside.

Each id has a state: how many of its rows came so far, one number per id. The state lies in the checkpoint, so a
query that is started again goes on where it was. No id is ever forgotten: with a watermark Spark would drop late
rows, and a gate may drop none. For very many ids set Spark's RocksDB state store, which keeps them on disk.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mendwork.functions.text import strip

# Rows without an id share no state; they are dealt to so many groups.
BLANK_GROUPS = 1024
# Texts of rows keep NULLs and microseconds.
AS_TEXT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _id_key(column: str) -> Column:
    return F.coalesce(strip(F.col(f"`{column}`").cast("string")), F.lit(""))


def numbered(stream: DataFrame, id_column: str) -> DataFrame:
    """Every row with ``occurrence``: 1 for the first row of its id, 2 for the second, …; 0 without an id.

    Rows of an id that arrive in one micro-batch are numbered in no particular order. Blank ids count as missing.
    """
    columns = [F.col(f"`{c}`") for c in stream.columns]
    key = _id_key(id_column)
    spread = F.when(key == "", F.pmod(F.xxhash64(*columns), F.lit(BLANK_GROUPS))).otherwise(0)
    # The row travels as one text: pandas would turn whole numbers with gaps into doubles, and NaN into NULL.
    packed = stream.select(key.alias("_id"), spread.alias("_part"), F.to_json(F.struct(*columns), AS_TEXT).alias("row"))

    def count(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        for batch in batches:
            if group[0] == "":
                yield pd.DataFrame({"row": batch["row"], "occurrence": 0})
                continue
            yield pd.DataFrame({"row": batch["row"], "occurrence": range(seen + 1, seen + 1 + len(batch))})
            seen += len(batch)
        if group[0] != "":
            state.update((seen,))

    groups = packed.groupBy("_id", "_part")
    counted = groups.applyInPandasWithState(count, "row string, occurrence long", "seen long", "append", GroupStateTimeout.NoTimeout)
    return counted.select(F.from_json("row", stream.schema, AS_TEXT).alias("row"), "occurrence").select("row.*", "occurrence")


def start_duplicate_gate(
    stream: DataFrame,
    id_column: str,
    accepted_path: str,
    quarantine_path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Write first rows (and rows without an id) to one folder, repeats with their number to the other.

    Each micro-batch has a folder of its own, so a batch that is run again after a failure replaces its earlier attempt.
    """
    marked = numbered(stream, id_column)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for folder, kept in (
                (accepted_path, batch.filter("occurrence <= 1").drop("occurrence")),
                (quarantine_path, batch.filter("occurrence > 1")),
            ):
                kept.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = marked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
