"""A table with the published marginal counts, and properties of the whole job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mendwork.functions.fixed_values import CARD_MAP, CITY_MAP, STATUS_MAP
from mendwork.operators import accuracy, canonical, completeness, consistency, duplicates, quality
from mendwork.plans import transactions as tx

ROWS = 10_103

# Rows per raw value.
STATUS = {"fail": 4005, "success": 3963, "failed": 1193, "Success": 498, "FAIL": 223, "succeed": 221}
CARD = {
    "Visa": 2383, "Discover": 1663, "MasterCard": 1461, "Amex": 1275, "MastCard": 1010, "Vsa": 810,
    "Master-Card": 601, None: 314, "visa": 208, "Master Card": 196, "VISA": 182,
}
CITY = {
    "Tehran": 2279, "Tabriz": 1381, "Isfahan": 1084, "Mashhad": 909, "Shiraz": 734, "Qom": 676,
    "Karaj": 649, "Ahvaz": 638, "THR": 414, "TEHRAN": 408, "karaj": 399, "tehr@n": 335, None: 117, "ThRan": 80,
}


def _spread(counts, step):
    """Values with the given counts, in an order of its own per column."""
    flat = [v for v, n in counts.items() for _ in range(n)]
    assert len(flat) == ROWS
    return [flat[i * step % ROWS] for i in range(ROWS)]


def _times():
    stamps = {f"2025-09-{d:02d} {h:02d}:{m:02d}:00": 1 for d in range(1, 31) for h in range(24) for m in range(60)}
    standard = dict.fromkeys(list(stamps)[:10_000], 1)
    swapped = {f"{i % 24:02d}:{i % 60:02d} 2025-09-{i % 28 + 1:02d}": 0 for i in range(76)}
    counts = {**standard, **dict.fromkeys(swapped, 1), None: 8, "99:99 2025-13-40": 10, "25:61 2025-09-11": 4,
              "12:00": 1, "3pm 2025/09/11": 2, "03-00-2025 09-11": 2}
    counts[next(iter(swapped))] += 76 - len(swapped)
    return counts


def _amounts():
    counts, negative = {}, 1217
    for i in range(9791 - 299):
        counts[("-" if i < negative else "") + str(100 + i * 100)] = 1
    for i in range(309):
        counts[f"{1000 + i * 2000}.50"] = 1
    return {**counts, "one hundred": 1, None: 2, "9999999999": 299}


@pytest.fixture(scope="module")
def raw(spark):
    columns = zip(
        range(ROWS), _spread(STATUS, 17), _spread(_times(), 29), _spread(CARD, 37), _spread(CITY, 41), _spread(_amounts(), 53)
    )
    rows = [(k, s, t, c, y, a, str(k % 99 + 1)) for k, s, t, c, y, a in columns]
    df = spark.createDataFrame(rows, "k int, status string, time string, card_type string, city string, amount string, id string")
    return df.repartition(6).cache()


@pytest.fixture(scope="module")
def result(raw):
    return tx.run(raw, tx.Options(order_by=["k"], max_year=2025))


def _counts(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_canonical_counts(result):
    assert _counts(result.frame, "status_clean") == {"failed": 5421, "success": 4682}
    assert _counts(result.frame, "card_type_clean") == {"Visa": 3583, "MasterCard": 3268, "Discover": 1663, "Amex": 1275, None: 314}
    assert _counts(result.frame, "city_clean") == {
        "Tehran": 3516, "Tabriz": 1381, "Isfahan": 1084, "Karaj": 1048, "Mashhad": 909, "Shiraz": 734, "Qom": 676, "Ahvaz": 638, None: 117,
    }


def test_time_counts(raw, result):
    status = {r.status: r.row_count for r in accuracy.datetime_accuracy(raw, "time").collect()}
    assert status == {"valid": 10_076, "impossible_date_or_time": 14, "invalid": 5, "NULL": 8}
    assert result.frame.filter("date_clean IS NULL").count() == 23
    assert result.frame.filter("clock_time_clean IS NOT NULL").count() == 10_080


def test_amount_counts(raw, result):
    kinds = {r.amount_format_type: r.row_count for r in consistency.number_kind_profile(raw, "amount").collect()}
    assert kinds == {"integer": 9791, "decimal": 309, "non_numeric": 1, "NULL": 2}
    detail = {r.metric: r.value for r in accuracy.amount_accuracy_detail(raw, "amount").collect()}
    assert detail["Negative amounts (converted to positive)"] == 1217
    assert result.frame.filter("amount_clean IS NULL").count() == 301
    assert result.frame.filter("amount_clean = 100.0 AND amount = 'one hundred'").count() == 1


def test_missing_cells(raw, result):
    before = completeness.overall_completeness(raw.drop("k")).first()
    assert (before.total_cells, before.missing_cells, before.complete_pct) == (60_618, 441, 99.27)
    options = tx.Options(order_by=["k"], max_year=2025)
    after = completeness.overall_completeness(tx.star(result.frame, options)["fact"]).first()
    assert (after.total_cells, after.missing_cells, after.complete_pct) == (70_721, 778, 98.9)


def test_ids_and_keys(raw, result):
    summary = {r.metric: r.value for r in duplicates.duplicate_id_summary(raw, "id").collect()}
    assert summary["Rows with duplicated ID"] == ROWS
    assert duplicates.key_uniqueness(raw, "id").first().distinct_values == 99
    keys = duplicates.key_uniqueness(result.frame, "transaction_id").first()
    assert tuple(keys) == (ROWS, ROWS, 0)
    assert result.frame.filter("transaction_id = 'TRX_10103'").first().k == ROWS - 1
    assert duplicates.duplicate_row_groups(raw.drop("k")).count() == 0


def test_fragmentation_and_compliance(raw):
    cards = {r.canonical: r for r in canonical.fragmentation(raw, "card_type", CARD_MAP).collect()}
    assert (cards["Visa"].exact_count, cards["Visa"].canonical_count, cards["Visa"].undercount_pct) == (2383, 3583, 50.36)
    canon = {"status": ["success", "failed"], "card_type": sorted(set(CARD_MAP.values())), "city": sorted(set(CITY_MAP.values()))}
    rows = {r["column"]: r.non_canonical_rows for r in canonical.domain_compliance(raw, canon).collect()}
    assert rows == {"status": 4947, "card_type": 3007, "city": 1636}


def test_summary_and_issues(result):
    summary = {r.metric: r.value for r in result.summary.collect()}
    assert summary["amount_outlier_nulled"] == 299 and summary["amount_outlier_rows"] == 0
    assert summary["time_valid_rows"] == 10_080 and summary["time_invalid_rows"] == 23
    assert summary["time_null_rows"] == 0
    issues = {(r["column"], r.issue): r.row_count for r in result.issues.collect()}
    assert issues["id", "duplicated original id rows"] == ROWS
    assert quality.affected_cells(result.issues).first()[0] == sum(issues.values())


def test_snapshot_adds_up(result):
    for r in quality.quality_snapshot(result.frame).collect():
        assert r.before_valid + r.before_invalid + r.before_null == ROWS
        assert r.after_valid + r.after_invalid + r.after_null == ROWS


def test_cleaning_twice_changes_nothing(result):
    again = result.transformed.select(
        F.col("transaction_id").alias("k"), "id", "status",
        F.concat_ws(" ", "date", "time").alias("time"), "card_type", "city", F.col("amount").cast("string").alias("amount"),
    )
    once = tx.run(again, tx.Options(order_by=["k"], max_year=2025)).transformed.drop("transaction_id", "id")
    before = result.transformed.drop("transaction_id", "id")
    assert once.exceptAll(before).count() == 0 and before.exceptAll(once).count() == 0


def test_one_pass_keeps_the_second_round(raw):
    frame = tx.run(raw, tx.Options(order_by=["k"], max_year=2025, passes=1)).frame
    assert frame.filter("amount_outlier_flag").count() == 0


def test_the_source_is_read_once(spark, raw, tmp_path):
    """Every later read is of the written rows: removing the source changes nothing."""
    raw.drop("k").withColumn("k", F.col("id")).write.parquet(str(tmp_path / "raw"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(str(tmp_path / "raw"))
    source = source.mapInArrow(counted, source.schema)
    result = tx.run(source, tx.Options(order_by=["k", "time"], max_year=2025))
    result.frame.count()
    result.summary.collect()
    result.issues.collect()
    assert reads.value == ROWS


def test_status_map_is_closed():
    assert set(STATUS_MAP.values()) <= set(STATUS_MAP)
