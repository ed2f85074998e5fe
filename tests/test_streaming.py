"""The gate and the monitor on file streams."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks.base import dirty, table
from checks.validating import gappy
from mendwork.operators import duplicates
from mendwork.streaming import gate, monitor, repeated_ids

FOLDER = "/root/testdata/sf0.001"


def test_gate_on_a_stream_equals_the_batch(spark, tmp_path):
    batch = dirty(spark, FOLDER)
    source = str(tmp_path / "in")
    batch.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rules = gate.transaction_rules()
    accepted, quarantine = str(tmp_path / "accepted"), str(tmp_path / "quarantine")
    query = gate.start_gate(stream, rules, accepted, quarantine, str(tmp_path / "checkpoint"), once=True)
    query.awaitTermination(120)
    judged = gate.apply_gate(batch, rules)
    good = spark.read.parquet(accepted).select("k")
    bad = spark.read.parquet(quarantine).select("k", "failed_rules")
    assert good.exceptAll(judged.filter("accepted").select("k")).count() == 0
    assert good.count() == judged.filter("accepted").count() > 0
    assert bad.exceptAll(judged.filter("NOT accepted").select("k", "failed_rules")).count() == 0
    assert good.count() + bad.count() == batch.count()


def test_unknown_counts_as_failed(spark):
    df = spark.createDataFrame(
        [("success", "Visa", "Qom", "5"), (None, "Visa", "Qom", "5"), ("failed", "Amex", "Rome", "-1")],
        "status string, card_type string, city string, amount string",
    )
    rows = [(r.failed_rules, r.accepted) for r in gate.apply_gate(df, gate.transaction_rules()).collect()]
    assert rows == [("", True), ("status_domain", False), ("city_domain,amount_positive", False)]


def test_monitor_on_a_stream_equals_the_batch(spark, tmp_path):
    events = gappy(table(spark, FOLDER, "events")).orderBy("ts")
    source = str(tmp_path / "in")
    events.repartitionByRange(3, "ts").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rates = monitor.null_rate_by_window(stream, "ts", ["event_type", "value"], watermark="400 days")
    query = (
        rates.writeStream.outputMode("complete").format("memory").queryName("rates")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    want = monitor.null_rate_by_window(events, "ts", ["event_type", "value"])
    got = spark.table("rates")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_closed_windows_are_emitted_once(spark, tmp_path):
    rows = spark.range(96).select(
        F.expr("timestamp'2025-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("ts"),
        F.when(F.col("id") % 4 > 0, F.lit("x")).alias("v"),
    )
    source = str(tmp_path / "in")
    rows.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    rates = monitor.null_rate_by_window(stream, "ts", ["v"])
    query = (
        rates.writeStream.outputMode("append").format("memory").queryName("closed")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    closed = spark.table("closed").collect()
    assert len(closed) == 3  # the fourth day is still open at the watermark
    assert all((r.row_count, r.v_null_rows, r.v_null_pct) == (24, 6, 25.0) for r in closed)


def _feed(spark, rows, path):
    spark.createDataFrame(rows, "id string, n long, ts timestamp, price double").coalesce(1).write.mode("append").parquet(path)


def test_repeated_ids_after_a_restart(spark, tmp_path):
    source, place = str(tmp_path / "in"), str(tmp_path)
    at = datetime.datetime(2025, 1, 1)
    parts = [
        [("a", 1, at, 1.5), ("b", None, at, None), (None, 3, None, 0.1), (" ", 4, at, float("nan"))],
        [("a", 5, at, 1.0), ("c", 2**53 + 1, at, 1.0), (" a ", 7, at, 1.0)],
    ]
    for part in parts:
        _feed(spark, part, source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        # Each part is read by a query of its own that starts from the checkpoint of the one before.
        repeated_ids.start_duplicate_gate(stream, "id", f"{place}/good", f"{place}/bad", f"{place}/check", once=True).awaitTermination(120)
    good, bad = spark.read.parquet(f"{place}/good"), spark.read.parquet(f"{place}/bad")
    assert sorted((r.n or 0) for r in good.collect()) == [0, 1, 3, 4, 2**53 + 1]
    assert sorted((r.n, r.occurrence) for r in bad.collect()) in ([(5, 2), (7, 3)], [(5, 3), (7, 2)])
    # Values come through as they were.
    whole = spark.read.parquet(source)
    both = good.drop("batch_id").unionByName(bad.select(whole.columns))
    assert both.exceptAll(whole).count() == 0 and both.count() == 7
    want = sorted(map(tuple, duplicates.duplicate_id_summary(whole, "id").collect()))
    assert sorted(map(tuple, duplicates.duplicate_id_summary(both, "id").collect())) == want
