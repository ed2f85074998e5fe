"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
All rows and columns are computed (noop sink), the plan is built anew every time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import checks.all  # noqa: E402,F401
from checks.base import QUERIES  # noqa: E402
from mendwork import build_session  # noqa: E402

HEADLINE = [
    "a_p1_column_completeness",
    "a_p5_value_profile_city",
    "a_p6_amount_format_type",
    "a_p7_samples_per_group",
    "a_p9_datetime_accuracy",
    "a_p10_amount_accuracy",
    "a_p12_classify_time",
    "a_c2_parse_mixed_datetime",
    "a_c5_salvage_time_text",
    "a_t1_map_status",
    "a_o1_iqr_bounds",
    "a_o1_iqr_bounds_by_range",
    "a_o3_status_outlier_crosstab",
    "a_d1_lineitem_orders",
    "a_d3_exact_duplicate_groups",
    "a_n4_surrogate_key",
    "a_n4_surrogate_key_sliced",
    "a_n9_run_reengineering",
    "a_q1_quality_snapshot",
    "b_n6_star_fact",
    "b_n7_retail_clean",
    "b_q11_referential_integrity",
    "b_b1_success_rate_by_city",
    "b_b2_revenue_by_card",
    "c_b3_stratified_iqr",
    "c_b7_constraint_gate",
    "c_b8_null_rate_monitor",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    result = {
        "metric": "total_time_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
