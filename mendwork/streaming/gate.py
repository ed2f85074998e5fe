"""Constraint gate at the point of entry: accept or quarantine every row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from mendwork.functions.fixed_values import CARD_MAP, CITY_MAP, STATUS_MAP
from mendwork.functions.numeric import to_number
from mendwork.functions.text import strip


def in_domain(column: str, canon: Mapping[str, str]) -> Column:
    return strip(F.col(column)).isin(*sorted(set(canon.values())))


def transaction_rules() -> dict[str, Column]:
    """Canonical status, city from the approved list, amount a positive number."""
    return {
        "status_domain": in_domain("status", STATUS_MAP),
        "card_domain": in_domain("card_type", CARD_MAP),
        "city_domain": in_domain("city", CITY_MAP),
        "amount_positive": to_number(F.col("amount"), None) > 0,
    }


def apply_gate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules`` (comma separated) and ``accepted``; unknown counts as failed.

    Row-local, so it runs unchanged on a stream, without state.
    """
    failed = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    judged = df.withColumn("failed_rules", F.concat_ws(",", *failed))
    return judged.withColumn("accepted", F.col("failed_rules") == "")


def gate_summary(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per combination of failed rules."""
    judged = apply_gate(df, rules)
    return judged.groupBy("accepted", "failed_rules").agg(F.count("*").alias("row_count"))


def start_gate(
    stream: DataFrame,
    rules: Mapping[str, Column],
    accepted_path: str,
    quarantine_path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Write accepted rows and quarantined rows to two parquet folders.

    Both come from one pass over a micro-batch, and each batch has a folder of its
    own, so a batch that is run again after a failure replaces its earlier attempt.
    """
    judged = apply_gate(stream, rules)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for folder, kept in (
                (accepted_path, batch.filter("accepted").drop("failed_rules", "accepted")),
                (quarantine_path, batch.filter("NOT accepted").drop("accepted")),
            ):
                kept.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = judged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
