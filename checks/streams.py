"""The gate and the monitor as Structured Streaming jobs that run until the input is read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import DIRTY, SQL, dirty_from, query, stream
from checks.validating import gappy
from mendwork.operators import duplicates
from mendwork.session import shared_folder
from mendwork.streaming import gate, monitor, repeated_ids


@query("c_b7_constraint_gate_stream", SQL["c_b7_constraint_gate"])
def _(spark, folder):
    source = dirty_from(stream(spark, folder, "orders"))
    place = f"{shared_folder(spark)}/gate-{uuid.uuid4().hex}"
    accepted, quarantine = f"{place}/accepted", f"{place}/quarantine"
    running = gate.start_gate(
        source, gate.transaction_rules(), accepted, quarantine, f"{place}/checkpoint", once=True
    )
    running.awaitTermination()
    judged = gate.apply_gate(source, gate.transaction_rules()).drop("accepted").schema
    good = spark.read.schema(source.schema).parquet(accepted).drop("batch_id")
    bad = spark.read.schema(judged).parquet(quarantine).drop("batch_id")
    good = good.withColumns({"failed_rules": F.lit(""), "accepted": F.lit(True)})
    return good.unionByName(bad.withColumn("accepted", F.lit(False)))


# The last day's window is still open when the input ends: its end lies beyond the watermark.
@query("c_b8_null_rate_monitor_stream", f"""SELECT * FROM ({SQL["c_b8_null_rate_monitor"]}) AS windows
WHERE window_end <= (SELECT strftime(max(ts) - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') FROM events)""")
def _(spark, folder):
    events = gappy(stream(spark, folder, "events"))
    place = f"{shared_folder(spark)}/monitor-{uuid.uuid4().hex}"
    running = monitor.start_monitor(
        events, "ts", ["event_type", "value"], f"{place}/rates", f"{place}/checkpoint", once=True
    )
    running.awaitTermination()
    schema = monitor.null_rate_by_window(events, "ts", ["event_type", "value"]).schema
    result = spark.read.schema(schema).parquet(f"{place}/rates").drop("batch_id")
    return result.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
    )


@query("a_d1_duplicate_ids_stream", SQL["a_d1_duplicate_id_summary"])
def _(spark, folder):
    """The same summary from what the stream let through and put aside."""
    source = dirty_from(stream(spark, folder, "orders"))
    place = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    accepted, quarantine = f"{place}/accepted", f"{place}/quarantine"
    repeated_ids.start_duplicate_gate(source, "id", accepted, quarantine, f"{place}/checkpoint", once=True).awaitTermination()
    good = spark.read.schema(source.schema).parquet(accepted)
    bad = spark.read.schema(source.schema).parquet(quarantine)
    return duplicates.duplicate_id_summary(good.unionByName(bad), "id")


@query("c_b7_first_rows_per_id_stream", DIRTY + """SELECT count(*) AS accepted_rows, count(DISTINCT id) AS accepted_ids,
  (SELECT count(*) - count(DISTINCT id) FROM dirty) AS quarantined_rows FROM (SELECT id FROM dirty GROUP BY id)""")
def _(spark, folder):
    source = dirty_from(stream(spark, folder, "orders"))
    place = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    accepted, quarantine = f"{place}/accepted", f"{place}/quarantine"
    repeated_ids.start_duplicate_gate(source, "id", accepted, quarantine, f"{place}/checkpoint", once=True).awaitTermination()
    counts = spark.read.schema(source.schema).parquet(accepted).agg(F.count("*").alias("accepted_rows"), F.count_distinct("id").alias("accepted_ids"))
    return counts.withColumn("quarantined_rows", F.lit(spark.read.schema(source.schema).parquet(quarantine).count()))
