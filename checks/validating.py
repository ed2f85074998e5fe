"""Quality reports, validation and questions on the cleaned data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import (
    CARD_SQL, CITY_SQL, CLEAN, DIRTY, DONE, RAW_COLUMNS, SQL, STATUS_SQL, dirty, number_sql, query, raw,
    table, unpivot_counts,
)
from checks.cleaning import OPTIONS, cleansed, transformed
from checks.profiling import _DT, AMOUNT_CLASS, TIME_CLASS, _AMOUNT, class_sql
from mendwork.functions import formats
from mendwork.functions.fixed_values import CARD_MAP, CITY_MAP, STATUS_MAP
from mendwork.functions.mapping import canonical
from mendwork.functions.nulls import is_null_like
from mendwork.functions.numeric import to_number
from mendwork.operators import (
    analytics, canonical as canon, completeness, consistency, duplicates, outliers, quality, star,
)
from mendwork.plans import transactions as tx
from mendwork.session import shared_folder
from mendwork.sources import sinks
from mendwork.streaming import gate, monitor


# --- reports -----------------------------------------------------------------------

def _category(c: str) -> tuple[str, ...]:
    null = f"count(*) FILTER (coalesce(trim({c}), '') = '')"
    bad = f"count(*) FILTER ({c}_invalid_flag)"
    return (f"'{c}'", f"count(*) - {null} - {bad}", bad, null, f"count({c}_clean)", bad, f"count(*) - count({c}_clean) - {bad}")


_BAD = f"""(({number_sql('amount', False)}) IS NULL AND coalesce(amount, '') <> '')
  OR coalesce(({number_sql('amount', False)}) < 0, false) OR amount_outlier_flag"""
_NULL_AMOUNT = "count(*) FILTER (coalesce(amount, '') = '')"
_SNAPSHOT_NAMES = ('"column"', "before_valid", "before_invalid", "before_null", "after_valid", "after_invalid", "after_null")


@query("a_q1_quality_snapshot", DONE + unpivot_counts("done", [
    _category("status"), _category("card_type"), _category("city"),
    ("'time'", "count(*) FILTER (time_valid_flag)", "count(*) FILTER (time_invalid_flag)", "count(*) FILTER (coalesce(time, '') = '')",
     "count(*) FILTER (time_valid_flag)", "0::bigint", "count(*) FILTER (NOT time_valid_flag)"),
    ("'amount'", f"count(*) - {_NULL_AMOUNT} - count(*) FILTER ({_BAD})", f"count(*) FILTER ({_BAD})", _NULL_AMOUNT,
     "count(amount_clean)", "count(*) FILTER (amount_non_numeric_flag)",
     "count(*) - count(amount_clean) - count(*) FILTER (amount_non_numeric_flag)")], _SNAPSHOT_NAMES))
def _(spark, folder):
    return quality.quality_snapshot(transformed(spark, folder))


@query("a_q1_snapshot_from_states", SQL["a_q1_quality_snapshot"])
def _(spark, folder):
    """Stored by month in three parts, one month twice."""
    frame = transformed(spark, folder)
    path = f"{shared_folder(spark)}/states-{uuid.uuid4().hex}"
    day, month = F.trunc("date_clean", "month"), F.month("date_clean")
    for part in (F.coalesce(month <= 6, F.lit(True)), month > 6, month == 3):
        quality.store_states(quality.snapshot_states(frame.where(part), day), path)
    return quality.merged_snapshot(spark.read.parquet(path))


def _raw_state(c: str, expression: str) -> str:
    bad = f"(({expression}) IS NULL AND coalesce(trim({c}), '') <> '')"
    null = f"coalesce(trim({c}), '') = ''"
    return f"""SELECT '{c}' AS "column", count(*) FILTER (NOT {bad} AND NOT ({null})) AS before_valid,
  count(*) FILTER ({bad}) AS before_invalid, count(*) FILTER ({null}) AS before_null FROM dirty"""


_POSITIVE = f"CASE WHEN ({number_sql('amount', False)}) >= 0 THEN 1 END"
_BEFORE = " UNION ALL ".join([
    _raw_state("status", STATUS_SQL), _raw_state("card_type", CARD_SQL), _raw_state("city", CITY_SQL),
    _raw_state("time", f"CASE WHEN {_DT} = 'valid' THEN 1 END"), _raw_state("amount", _POSITIVE)])


@query("a_q1_snapshot_raw_baseline", DONE + f""", before AS ({_BEFORE}),
after AS ({unpivot_counts('done', [
    *[(f"'{c}'", f"count({c}_clean)", f"count(*) FILTER ({c}_invalid_flag)", f"count(*) - count({c}_clean) - count(*) FILTER ({c}_invalid_flag)")
      for c in ('status', 'card_type', 'city')],
    ("'time'", "count(*) FILTER (time_valid_flag)", "0::bigint", "count(*) FILTER (NOT time_valid_flag)"),
    ("'amount'", "count(amount_clean)", "count(*) FILTER (amount_non_numeric_flag)",
     "count(*) - count(amount_clean) - count(*) FILTER (amount_non_numeric_flag)")],
    ('"column"', "after_valid", "after_invalid", "after_null"))})
SELECT * FROM before JOIN after USING ("column")""")
def _(spark, folder):
    maps = {"status": STATUS_MAP, "card_type": CARD_MAP, "city": CITY_MAP}
    return quality.snapshot_against(transformed(spark, folder), dirty(spark, folder), maps)


_ISSUES = [
    ("'status'", "'invalid status values'", "count(*) FILTER (status_invalid_flag)"),
    ("'time'", "'invalid datetime values'", "count(*) FILTER (time_invalid_flag)"),
    ("'card_type'", "'invalid card_type values'", "count(*) FILTER (card_type_invalid_flag)"),
    ("'city'", "'invalid city values'", "count(*) FILTER (city_invalid_flag)"),
    ("'amount'", "'non-numeric values'", "count(*) FILTER (amount_non_numeric_flag)"),
    ("'amount'", "'negative values'", "count(*) FILTER (amount_negative_flag)"),
    ("'amount'", "'IQR outlier values'", "count(*) FILTER (amount_outlier_flag)"),
    ("'id'", "'duplicated original id rows'", "(SELECT coalesce(sum(n), 0)::bigint FROM (SELECT count(*) AS n FROM done GROUP BY id HAVING count(*) > 1)) + 0 * count(*)"),
]
_ISSUE_SQL = unpivot_counts("done", _ISSUES, ('"column"', "issue", "row_count"))


@query("a_q2_issue_counts", DONE + _ISSUE_SQL)
def _(spark, folder):
    return quality.issue_counts(transformed(spark, folder))


@query("a_q2_affected_cells", DONE + f"SELECT sum(row_count)::bigint AS affected_cells FROM ({_ISSUE_SQL})")
def _(spark, folder):
    return quality.affected_cells(quality.issue_counts(transformed(spark, folder)))


@query("a_q3_invalid_time_rows", DONE + "SELECT transaction_id, id, time FROM done WHERE time_invalid_flag")
def _(spark, folder):
    return quality.invalid_time_rows(tx.run(dirty(spark, folder), OPTIONS).frame)


_OUT = {"id": "id", "transaction_id": "transaction_id", "status": "status_clean", "date": "date_clean",
        "time": "clock_time_clean", "card_type": "card_type_clean", "city": "city_clean", "amount": "amount_clean"}


def _null_like(c: str) -> str:
    return f"count(*) FILTER ({c} IS NULL OR trim({c}) = '' OR upper(trim({c})) = 'NULL')"


@query("a_q4_null_table", DONE + unpivot_counts("dirty", [
    ("'raw'", f"'{c}'", "count(*)", _null_like(c), f"round({_null_like(c)} / count(*) * 100, 2)") for c in RAW_COLUMNS],
    ("dataset", '"column"', "total_rows", "null_count", "null_pct")) + " UNION ALL " + unpivot_counts("done", [
    ("'normalised'", f"'{c}'", "count(*)", f"count(*) - count({e})", f"round((count(*) - count({e})) / count(*) * 100, 2)") for c, e in _OUT.items()],
    ("dataset", '"column"', "total_rows", "null_count", "null_pct")))
def _(spark, folder):
    result = tx.run(dirty(spark, folder), OPTIONS).transformed
    return completeness.null_tables((raw(spark, folder), "raw"), (result, "normalised"))


_MAP = {"status": "status", "time": "time", "amount": "amount", "id": "transaction_id", "card_type": "card_id", "city": "city_id", "k": "missing"}
_STAR_NULL = {"status": "status_clean", "time": "clock_time_clean", "amount": "amount_clean", "transaction_id": "transaction_id",
              "card_id": "card_type_clean", "city_id": "city_clean"}


def _delta(a: str, b: str) -> str:
    before = "NULL::bigint" if a == "k" else f"(SELECT {_null_like(a)} FROM dirty)"
    after = f"(SELECT count(*) - count({_STAR_NULL[b]}) FROM done)" if b in _STAR_NULL else "NULL::bigint"
    return f"""SELECT '{a}' AS transaction_column, '{b}' AS normalised_column, {before} AS transaction_null_count,
  {after} AS normalised_null_count, {after} - {before} AS null_count_change"""


@query("a_q5_null_delta", DONE + " UNION ALL ".join(_delta(a, b) for a, b in _MAP.items()))
def _(spark, folder):
    fact = tx.star(tx.run(dirty(spark, folder), OPTIONS).frame, OPTIONS)["fact"]
    return completeness.null_delta(raw(spark, folder), fact, _MAP)


_DAY_CLASS = class_sql("date_clean", [("YYYY-MM-DD", r"\d{4}-\d{2}-\d{2}")])
_CLOCK_CLASS = class_sql("clock_time_clean", [("HH:MM:SS", r"\d{2}:\d{2}:\d{2}")])


@query("a_q6_time_format_comparison", DONE + f"""
SELECT 'transaction.time' AS dataset, {TIME_CLASS} AS format, count(*) AS row_count FROM dirty GROUP BY ALL
UNION ALL SELECT 'normalise.time', {_CLOCK_CLASS}, count(*) FROM done GROUP BY ALL
UNION ALL SELECT 'normalise.date', {_DAY_CLASS}, count(*) FROM done GROUP BY ALL""")
def _(spark, folder):
    norm = transformed(spark, folder)
    return consistency.format_comparison(
        (dirty(spark, folder), "transaction.time", formats.classify_time(F.col("time"))),
        (norm, "normalise.time", formats.classify_clock(F.col("clock_time_clean"))),
        (norm, "normalise.date", formats.classify_date(F.col("date_clean"))),
    )


_NORM_AMOUNT = AMOUNT_CLASS.replace("amount)", "amount_text)").replace("amount,", "amount_text,")


@query("a_q6_amount_format_comparison", DONE + f"""
SELECT 'transaction.amount' AS dataset, {AMOUNT_CLASS} AS format, count(*) AS row_count FROM dirty GROUP BY ALL
UNION ALL SELECT 'normalise.amount', {_NORM_AMOUNT}, count(*) FROM (SELECT CAST(amount_clean AS varchar) AS amount_text FROM done) GROUP BY ALL""")
def _(spark, folder):
    from mendwork.functions.numeric import float_text

    norm = transformed(spark, folder).select(float_text(F.col("amount_clean")).alias("amount"))
    return consistency.format_comparison(
        (dirty(spark, folder), "transaction.amount", formats.classify_amount(F.col("amount"))),
        (norm, "normalise.amount", formats.classify_amount(F.col("amount"))),
    )


@query("a_q7_side_by_side_card", DONE + """, a AS (SELECT v, row_number() OVER (ORDER BY v) AS position FROM (SELECT DISTINCT trim(card_type) AS v FROM dirty WHERE card_type IS NOT NULL)),
b AS (SELECT v, row_number() OVER (ORDER BY v) AS position FROM (SELECT DISTINCT card_type_clean AS v FROM done WHERE card_type_clean IS NOT NULL))
SELECT coalesce(a.position, b.position) AS position, a.v AS transaction_card_type, b.v AS normalise_card_type FROM a FULL JOIN b ON a.position = b.position""")
def _(spark, folder):
    return consistency.side_by_side_values(
        dirty(spark, folder), "card_type", transformed(spark, folder), "card_type_clean",
        "transaction_card_type", "normalise_card_type",
    )


@query("a_q7_side_by_side_status", DONE + """, a AS (SELECT v, row_number() OVER (ORDER BY v) AS position FROM (SELECT DISTINCT trim(status) AS v FROM dirty WHERE coalesce(trim(status), '') <> '')),
b AS (SELECT v, row_number() OVER (ORDER BY v) AS position FROM (SELECT DISTINCT status_clean AS v FROM done WHERE status_clean IS NOT NULL))
SELECT coalesce(a.position, b.position) AS position, a.v AS transaction_status, b.v AS normalise_status FROM a FULL JOIN b ON a.position = b.position""")
def _(spark, folder):
    return consistency.side_by_side_values(
        dirty(spark, folder), "status", transformed(spark, folder), "status_clean",
        "transaction_status", "normalise_status",
    )


def _distinct(c: str, source: str) -> str:
    return f"(SELECT count(DISTINCT trim({c})) FROM {source} WHERE NOT ({c} IS NULL OR trim({c}) = '' OR upper(trim({c})) = 'NULL'))"


@query("a_q8_comparison_summary", DONE + f"""
SELECT 'rows' AS "check", (SELECT count(*) FROM dirty) AS transaction, (SELECT count(*) FROM done) AS normalised
UNION ALL SELECT 'time/date valid-format buckets (count)', (SELECT count(DISTINCT {TIME_CLASS}) FROM dirty),
  (SELECT count(DISTINCT {_CLOCK_CLASS}) + count(DISTINCT {_DAY_CLASS}) FROM done)
UNION ALL SELECT 'amount format buckets', (SELECT count(DISTINCT {AMOUNT_CLASS}) FROM dirty),
  (SELECT count(DISTINCT {_NORM_AMOUNT}) FROM (SELECT CAST(amount_clean AS varchar) AS amount_text FROM done))
UNION ALL SELECT 'unique city values', {_distinct('city', 'dirty')}, {_distinct('city_clean', 'done')}
UNION ALL SELECT 'unique card values', {_distinct('card_type', 'dirty')}, {_distinct('card_type_clean', 'done')}
UNION ALL SELECT 'unique status values', {_distinct('status', 'dirty')}, {_distinct('status_clean', 'done')}""")
def _(spark, folder):
    norm = sinks.transformed_view(tx.run(dirty(spark, folder), OPTIONS).frame)
    clocks = "time/date valid-format buckets (count)"
    return consistency.comparison_summary(
        dirty(spark, folder), norm,
        {clocks: formats.classify_time(F.col("time")), "amount format buckets": formats.classify_amount(F.col("amount"))},
        {
            clocks: formats.classify_clock(F.col("time")),
            clocks + "#date": formats.classify_date(F.col("date")),
            "amount format buckets": formats.classify_amount(F.col("amount")),
        },
        [("unique city values", "city", "city"), ("unique card values", "card_type", "card_type"), ("unique status values", "status", "status")],
    )


def _spelled(c: str, expression: str) -> str:
    return f""", spelled AS (SELECT trim({c}) AS raw_value, {expression} AS canonical, count(*) AS row_count FROM dirty
  WHERE coalesce(trim({c}), '') <> '' GROUP BY ALL)"""


@query("b_q9_reconcile_status", DIRTY + _spelled("status", STATUS_SQL) + """SELECT canonical, raw_value, row_count,
  (sum(row_count) OVER (PARTITION BY canonical))::bigint AS canonical_count,
  round(row_count / sum(row_count) OVER (PARTITION BY canonical) * 100, 2) AS pct_of_canonical FROM spelled""")
def _(spark, folder):
    return canon.reconcile_mapping(dirty(spark, folder), "status", STATUS_MAP)


# Mappings as if the variants had never been written down.
_NAMES_ONLY = {c: {v.lower(): v for v in m.values()} for c, m in (("city", CITY_MAP), ("card_type", CARD_MAP))}


def _proposals(column: str, distance: int) -> str:
    """SQL: every unknown spelling against every name by edit distance."""
    names = sorted(set(_NAMES_ONLY[column].values()))
    listed = ", ".join(f"('{v}')" for v in names)
    return DIRTY + f""", names(name) AS (VALUES {listed}), raw_values AS (
  SELECT trim({column}) AS raw_value, count(*) AS row_count FROM dirty WHERE coalesce(trim({column}), '') <> ''
    AND lower(trim({column})) NOT IN ({', '.join(f"'{v.lower()}'" for v in names)}) GROUP BY 1),
near AS (SELECT *, levenshtein(lower(raw_value), lower(name)) AS distance FROM raw_values CROSS JOIN names),
best AS (SELECT * FROM near WHERE distance <= {distance} QUALIFY distance = min(distance) OVER (PARTITION BY raw_value))
SELECT raw_value, row_count, min(name) AS proposed, min(distance)::int AS distance, count(*)::int AS n_proposals FROM best GROUP BY 1, 2"""


@query("b_q9_propose_city", _proposals("city", 2))
def _(spark, folder):
    return canon.propose_mapping(dirty(spark, folder), "city", _NAMES_ONLY["city"], distance=2)


@query("b_q9_propose_card", _proposals("card_type", 1))
def _(spark, folder):
    return canon.propose_mapping(dirty(spark, folder), "card_type", _NAMES_ONLY["card_type"])


@query("b_q9_fragmentation_city", DIRTY + _spelled("city", CITY_SQL) + """, g AS (
  SELECT canonical, count(*) AS variants, sum(row_count)::bigint AS canonical_count,
    coalesce(sum(row_count) FILTER (raw_value = canonical), 0)::bigint AS exact_count FROM spelled WHERE canonical IS NOT NULL GROUP BY 1)
SELECT *, CASE WHEN exact_count = 0 THEN 0.0 ELSE round((canonical_count - exact_count) / exact_count * 100, 2) END::double AS undercount_pct FROM g""")
def _(spark, folder):
    return canon.fragmentation(dirty(spark, folder), "city", CITY_MAP)


_DOMAINS = {"status": STATUS_MAP, "card_type": CARD_MAP, "city": CITY_MAP}
_CANONS = {c: sorted(set(m.values())) for c, m in _DOMAINS.items()}


def _outside(c: str) -> str:
    listed = ", ".join(f"'{v}'" for v in _CANONS[c])
    return f"count(*) FILTER (coalesce(trim({c}), '') <> '' AND trim({c}) NOT IN ({listed}))"


@query("b_q10_domain_compliance", DIRTY + unpivot_counts("dirty", [
    (f"'{c}'", "count(*)", _outside(c), f"round({_outside(c)} / count(*) * 100, 2)",
     f"round((count(*) - {_outside(c)}) / count(*) * 100, 2)") for c in _CANONS],
    ('"column"', "total_rows", "non_canonical_rows", "non_canonical_pct", "compliance_pct")))
def _(spark, folder):
    return canon.domain_compliance(dirty(spark, folder), _CANONS)


def _orphans(name: str, fact: str, fk: str, dim: str, pk: str) -> str:
    miss = f"{fk} NOT IN (SELECT {pk} FROM {dim})"
    return f"""SELECT '{name}' AS foreign_key, count({fk}) AS rows_checked, count(DISTINCT {fk}) FILTER ({miss}) AS orphan_keys,
  count({fk}) FILTER ({miss}) AS orphan_rows FROM {fact}"""


@query("b_q11_referential_integrity", "WITH rich AS (SELECT * FROM customer WHERE c_acctbal > 0) " + " UNION ALL ".join([
    _orphans("orders -> customer", "orders", "o_custkey", "customer", "c_custkey"),
    _orphans("lineitem -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("labels -> documents", "labels", "doc_id", "documents", "doc_id"),
    _orphans("orders -> customer in credit", "orders", "o_custkey", "rich", "c_custkey")]))
def _(spark, folder):
    t = {n: table(spark, folder, n) for n in ("orders", "customer", "lineitem", "labels", "documents")}
    return star.referential_integrity([
        ("orders -> customer", t["orders"], "o_custkey", t["customer"], "c_custkey"),
        ("lineitem -> orders", t["lineitem"], "l_orderkey", t["orders"], "o_orderkey"),
        ("labels -> documents", t["labels"], "doc_id", t["documents"], "doc_id"),
        ("orders -> customer in credit", t["orders"], "o_custkey", t["customer"].filter("c_acctbal > 0"), "c_custkey"),
    ])


@query("b_q12_key_uniqueness", DIRTY + """, n AS (SELECT id, count(*) AS n FROM dirty GROUP BY 1)
SELECT 'id' AS key_column, sum(n)::bigint AS total_rows, count(id) AS distinct_values, coalesce(sum(n) FILTER (n > 1 AND id IS NOT NULL), 0)::bigint AS duplicate_rows FROM n
UNION ALL SELECT 'transaction_id', count(*), count(*), 0 FROM dirty""")
def _(spark, folder):
    frame = tx.run(dirty(spark, folder), OPTIONS).frame
    return duplicates.key_uniqueness(dirty(spark, folder), "id").withColumn("key_column", F.lit("id")).unionByName(
        duplicates.key_uniqueness(frame, "transaction_id").withColumn("key_column", F.lit("transaction_id"))
    )


@query("b_q13_row_preservation", DONE + """SELECT 'raw' AS stage, count(*) AS row_count FROM dirty UNION ALL SELECT 'cleansed', count(*) FROM clean
UNION ALL SELECT 'normalised', count(*) FROM done""")
def _(spark, folder):
    return star.row_preservation([
        ("raw", dirty(spark, folder)), ("cleansed", cleansed(spark, folder)),
        ("normalised", tx.run(dirty(spark, folder), OPTIONS).frame),
    ])


_SCORE_MISS = " + ".join(_null_like(c) for c in RAW_COLUMNS)
_PRESENT = " + ".join(f"count(*) FILTER (coalesce(trim({c}), '') <> '')" for c in _CANONS)


@query("b_q14_scorecard", DIRTY + f""", s AS (SELECT (count(*) * 6 - ({_SCORE_MISS})) / (count(*) * 6) * 100 AS completeness,
  (({_PRESENT}) - ({' + '.join(_outside(c) for c in _CANONS)})) / ({_PRESENT}) * 100 AS consistency,
  count(*) FILTER ({_AMOUNT} = 'valid') / count(*) * 100 AS accuracy, count(DISTINCT id) / count(*) * 100 AS uniqueness,
  count(*) FILTER ({_DT} = 'valid') / count(*) * 100 AS validity FROM dirty)
""" + unpivot_counts("s", [*[(f"'{d}'", f"round({d}, 2)") for d in ("completeness", "consistency", "accuracy", "uniqueness", "validity")],
    ("'overall'", "round((completeness + consistency + accuracy + uniqueness + validity) / 5, 2)")], ("dimension", "score")))
def _(spark, folder):
    return quality.scorecard(raw(spark, folder), "id", _CANONS)


_SCORED = ["completeness", "consistency", "accuracy", "uniqueness", "validity"]
_AFTER = ["transaction_id", "status_clean", "date_clean", "clock_time_clean", "card_type_clean", "city_clean", "amount_clean"]
_CLEANED = ["status_clean", "card_type_clean", "city_clean"]


@query("b_q14_scorecard_change", DONE + f""", old AS (SELECT (count(*) * 6 - ({_SCORE_MISS})) / (count(*) * 6) * 100 AS completeness,
  (({_PRESENT}) - ({' + '.join(_outside(c) for c in _CANONS)})) / ({_PRESENT}) * 100 AS consistency,
  count(*) FILTER ({_AMOUNT} = 'valid') / count(*) * 100 AS accuracy, count(DISTINCT id) / count(*) * 100 AS uniqueness,
  count(*) FILTER ({_DT} = 'valid') / count(*) * 100 AS validity FROM dirty),
new AS (SELECT ({' + '.join(f'count({c})' for c in _AFTER)}) / (count(*) * 7) * 100 AS completeness,
  ({' + '.join(f'count({c})' for c in _CLEANED)}) / ({' + '.join(f'count({c})' for c in _CLEANED)}) * 100 AS consistency,
  count(*) FILTER (amount_clean > 0) / count(*) * 100 AS accuracy, count(DISTINCT transaction_id) / count(*) * 100 AS uniqueness,
  count(*) FILTER (date_clean IS NOT NULL AND clock_time_clean IS NOT NULL) / count(*) * 100 AS validity FROM done),
scores AS (""" + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, round(({o}), 2) AS before, round(({n}), 2) AS after FROM old, new" for d, o, n in [
        *[(d, f"old.{d}", f"new.{d}") for d in _SCORED],
        ("overall", *[f"({' + '.join(f'{side}.{d}' for d in _SCORED)}) / 5" for side in ("old", "new")])]) + """)
SELECT *, round(after - before, 2) AS change FROM scores""")
def _(spark, folder):
    after = sinks.transformed_frame(tx.run(dirty(spark, folder), OPTIONS).frame).drop("id")
    valid = F.col("date").isNotNull() & F.col("time").isNotNull()
    return quality.scorecard_change(
        quality.scorecard(raw(spark, folder), "id", _CANONS),
        quality.scorecard(after, "transaction_id", _CANONS, valid=valid),
    )


_RESIDUAL = {"Unknown card_type (NULL)": "card_type_clean IS NULL", "Unknown city (NULL)": "city_clean IS NULL",
             "NULL date / time": "date_clean IS NULL", "NULL amount": "amount_clean IS NULL",
             "succeed mapped to success": "coalesce(lower(status) = 'succeed', false)"}


@query("b_q15_residual_gaps", DONE + unpivot_counts("done", [
    (f"'{n}'", f"count(*) FILTER ({e})", f"round(count(*) FILTER ({e}) / count(*) * 100, 2)") for n, e in _RESIDUAL.items()],
    ("issue", "rows_affected", "pct")))
def _(spark, folder):
    return completeness.residual_gaps(transformed(spark, folder), {n: F.expr(e) for n, e in _RESIDUAL.items()})


# --- questions and follow-ups ------------------------------------------------------

@query("b_b1_success_rate_by_city", DONE + """, u AS (
  SELECT 'raw' AS version, city, status FROM dirty UNION ALL SELECT 'cleaned', city_clean, status_clean FROM done)
SELECT version, city, count(*) AS row_count, count(*) FILTER (status = 'success') AS success_rows,
  round(count(*) FILTER (status = 'success') / count(*) * 100, 2) AS success_pct FROM u GROUP BY 1, 2""")
def _(spark, folder):
    before = dirty(spark, folder)
    after = before.select(
        canonical(F.col("city"), CITY_MAP).alias("city"), canonical(F.col("status"), STATUS_MAP).alias("status")
    )
    parts = [
        analytics.success_rate(df, F.col("city"), F.col("status")).withColumn("version", F.lit(name))
        for name, df in (("raw", before), ("cleaned", after))
    ]
    return parts[0].unionByName(parts[1])


@query("b_b2_revenue_by_card", DONE + """SELECT card_type_clean AS card_type, sum(CAST(amount_clean AS decimal(18, 2)))::double AS revenue,
  count(amount_clean) AS amount_rows, count(*) - count(amount_clean) AS null_amount_rows FROM done GROUP BY 1""")
def _(spark, folder):
    frame = transformed(spark, folder)
    return analytics.revenue(frame, F.col("card_type_clean"), F.col("amount_clean"))


@query("c_b3_stratified_iqr", """WITH b AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM events WHERE value > 0 GROUP BY 1)
SELECT event_id, events.event_type, value, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS outlier_flag
FROM events JOIN b ON events.event_type = b.event_type""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return outliers.stratified_outliers(events, "value", ["event_type"])


@query("c_b4_null_cluster", DONE + """SELECT card_type_clean AS card_type, left(date_clean, 7) AS month,
  GROUPING(card_type_clean, left(date_clean, 7)) AS grouping_level, count(*) AS row_count,
  count(*) FILTER (amount_clean IS NULL) AS amount_rows, count(*) FILTER (parsed IS NULL) AS time_rows,
  round(count(*) FILTER (amount_clean IS NULL) / count(*) * 100, 2) AS amount_pct,
  round(count(*) FILTER (parsed IS NULL) / count(*) * 100, 2) AS time_pct
FROM done GROUP BY ROLLUP (card_type_clean, left(date_clean, 7))""")
def _(spark, folder):
    frame = transformed(spark, folder)
    by = {"card_type": F.col("card_type_clean"), "month": F.left("date_clean", F.lit(7))}
    flags = {"amount": F.col("amount_clean").isNull(), "time": F.col("time_parsed").isNull()}
    return analytics.null_cluster(frame, by, flags)


@query("c_b5_time_bucket", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_bucket,
  event_type, count(*) AS row_count FROM events GROUP BY ALL""")
def _(spark, folder):
    bucketed = analytics.time_bucket(table(spark, folder, "events"), "ts", "hour")
    label = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("hour_bucket")
    return bucketed.groupBy(label, "event_type").agg(F.count("*").alias("row_count"))


@query("c_b6_quasi_identifiers", DONE + """, g AS (SELECT count(*) AS group_size FROM done GROUP BY left(date_clean, 7), city_clean, card_type_clean)
SELECT group_size, count(*) AS groups, group_size * count(*) AS row_count FROM g GROUP BY 1""")
def _(spark, folder):
    frame = transformed(spark, folder).withColumn("month", F.left("date_clean", F.lit(7)))
    return analytics.quasi_identifier_uniqueness(frame, ["month", "city_clean", "card_type_clean"])


@query("c_b6_quasi_identifiers_exact", DONE + """, g AS (SELECT count(*) AS group_size FROM done GROUP BY time_clean, city_clean, amount_clean, card_type_clean)
SELECT group_size, count(*) AS groups, group_size * count(*) AS row_count FROM g GROUP BY 1""")
def _(spark, folder):
    columns = ["time_clean", "city_clean", "amount_clean", "card_type_clean"]
    return analytics.quasi_identifier_uniqueness(transformed(spark, folder), columns)


def _in(c: str) -> str:
    return f"coalesce(trim({c}) IN ({', '.join(repr(v) for v in _CANONS[c])}), false)"


_GATE = f"""concat_ws(',', CASE WHEN NOT {_in('status')} THEN 'status_domain' END, CASE WHEN NOT {_in('card_type')} THEN 'card_domain' END,
  CASE WHEN NOT {_in('city')} THEN 'city_domain' END, CASE WHEN NOT coalesce(({number_sql('amount', False)}) > 0, false) THEN 'amount_positive' END)"""


@query("c_b7_constraint_gate", DIRTY + f"SELECT *, {_GATE} AS failed_rules, {_GATE} = '' AS accepted FROM dirty")
def _(spark, folder):
    return gate.apply_gate(dirty(spark, folder), gate.transaction_rules())


@query("c_b7_gate_summary", DIRTY + f"SELECT {_GATE} = '' AS accepted, {_GATE} AS failed_rules, count(*) AS row_count FROM dirty GROUP BY ALL")
def _(spark, folder):
    return gate.gate_summary(dirty(spark, folder), gate.transaction_rules())


_GAPPY = """WITH gappy AS (SELECT ts, CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END AS event_type,
  CASE WHEN value >= 100 THEN NULL ELSE value END AS value FROM events)"""


def gappy(df):
    """Events with gaps: nulls by event type and by value, blanks by id."""
    kind = F.when(F.col("event_type") != "error", F.when(F.col("event_id") % 11 == 0, " ").otherwise(F.col("event_type")))
    return df.select("ts", kind.alias("event_type"), F.when(F.col("value") < 100, F.col("value")).alias("value"))


@query("c_b8_null_rate_monitor", _GAPPY + """, w AS (SELECT date_trunc('day', ts) AS d, * FROM gappy)
SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(d + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS row_count,
  count(*) FILTER (coalesce(trim(event_type), '') = '') AS event_type_null_rows, count(*) - count(value) AS value_null_rows,
  round(count(*) FILTER (coalesce(trim(event_type), '') = '') / count(*) * 100, 2) AS event_type_null_pct,
  round((count(*) - count(value)) / count(*) * 100, 2) AS value_null_pct FROM w GROUP BY d""")
def _(spark, folder):
    rates = monitor.null_rate_by_window(gappy(table(spark, folder, "events")), "ts", ["event_type", "value"])
    return rates.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
    )
