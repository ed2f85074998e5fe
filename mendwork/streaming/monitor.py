"""Null rate per time window, for batch and streaming sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from mendwork.functions.nulls import NullPolicy, is_missing
from mendwork.functions.numeric import percent


def null_rate_by_window(
    df: DataFrame,
    time: str,
    columns: Sequence[str],
    window: str = "1 day",
    watermark: str = "1 hour",
    policy: NullPolicy = NullPolicy.NULL_LIKE,
) -> DataFrame:
    """Rows and null rate of every column per tumbling window.

    On a stream the watermark bounds the state to the windows that are still open;
    on a batch it has no effect. All rows of a window meet as partial counts only.
    Watermarks need a time with a zone: one without is read in the session's, which
    should be UTC.
    """
    source, local = df, dict(df.dtypes)[time] == "timestamp_ntz"
    if df.isStreaming:
        source = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    flags = [
        F.count_if(is_missing(df, c, policy)).alias(f"{c}_null_rows") for c in columns
    ]
    counts = source.groupBy(F.window(time, window).alias("_w")).agg(
        F.count("*").alias("row_count"), *flags
    )
    rates = [percent(F.col(f"{c}_null_rows"), F.col("row_count")).alias(f"{c}_null_pct") for c in columns]
    kind = "timestamp_ntz" if local else "timestamp"
    return counts.select(
        F.col("_w.start").cast(kind).alias("window_start"),
        F.col("_w.end").cast(kind).alias("window_end"),
        "row_count",
        *[f"{c}_null_rows" for c in columns],
        *rates,
    )


def start_monitor(
    stream: DataFrame,
    time: str,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    window: str = "1 day",
    watermark: str = "1 hour",
    policy: NullPolicy = NullPolicy.NULL_LIKE,
    once: bool = False,
) -> StreamingQuery:
    """Write each window once, when the watermark closes it; closed windows leave the state.

    Each micro-batch has a folder of its own, so one that is run again after a failure
    replaces its earlier attempt. Rows later than the watermark allows are left out.
    """
    rates = null_rate_by_window(stream, time, columns, window, watermark, policy)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = rates.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
