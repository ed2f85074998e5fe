"""Profiling, outliers and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    CLEAN, DIRTY, DONE, RAW_COLUMNS, dirty, number_sql, query, raw, table, unpivot_counts,
)
from checks.cleaning import OPTIONS, cleansed, timed, transformed
from mendwork.functions import formats
from mendwork.functions.fixed_values import TIME_LAYOUTS
from mendwork.functions.nulls import NullPolicy, is_null_like
from mendwork.functions.numeric import to_number
from mendwork.operators import (
    accuracy, completeness, consistency, duplicates, impute, outliers,
)
from mendwork.operators.quantiles import exact_quantiles
from mendwork.plans import transactions as tx


def _missing(c: str) -> str:
    return f"count(*) FILTER ({c} IS NULL OR {c} = '')"


_PCT = "round({} / count(*) * 100, 2)"


@query("a_p1_column_completeness", DIRTY + unpivot_counts("dirty", [
    (f"'{c}'", "count(*)", _missing(c), _PCT.format(_missing(c)), f"count(*) - {_missing(c)}",
     _PCT.format(f"(count(*) - {_missing(c)})")) for c in RAW_COLUMNS],
    ('"column"', "total_rows", "missing_count", "missing_pct", "complete_count", "complete_pct")))
def _(spark, folder):
    return completeness.column_completeness(raw(spark, folder))


_TEXT_TABLES = {"conversations": ["conv_id", "turn", "role", "text"], "pages": ["page_id", "url", "html"]}


@query("a_p1_completeness_text_tables", " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, '{c}' AS "column", count(*) AS total_rows,
    count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS varchar)) = '') AS missing_count FROM {t}"""
    for t, cols in _TEXT_TABLES.items() for c in cols))
def _(spark, folder):
    parts = [
        completeness.column_completeness(table(spark, folder, t), NullPolicy.BLANK)
        .select(F.lit(t).alias("dataset"), "column", "total_rows", "missing_count")
        for t in _TEXT_TABLES
    ]
    return parts[0].unionByName(parts[1])


_ALL_MISSING = " + ".join(_missing(c) for c in RAW_COLUMNS)


@query("a_p2_overall_completeness", DIRTY + f""", n AS (SELECT count(*) AS r, {_ALL_MISSING} AS m FROM dirty)
SELECT r AS total_rows, 6::bigint AS total_columns, r * 6 AS total_cells, m AS missing_cells,
  round(m / (r * 6) * 100, 2) AS missing_pct, r * 6 - m AS complete_cells,
  round((r * 6 - m) / (r * 6) * 100, 2) AS complete_pct FROM n""")
def _(spark, folder):
    return completeness.overall_completeness(raw(spark, folder))


@query("a_p3_before_after_missing", DIRTY + """, after AS (
  SELECT id, status, time, coalesce(nullif(card_type, ''), 'Unknown') AS card_type,
    coalesce(nullif(city, ''), 'Unknown') AS city, amount FROM dirty
  WHERE coalesce(amount, '') <> '' AND coalesce(time, '') <> '')
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT {_missing(c)} FROM dirty) AS before_missing,
    (SELECT {_missing(c)} FROM after) AS after_missing""" for c in RAW_COLUMNS))
def _(spark, folder):
    before = raw(spark, folder)
    after = impute.fill_unknown(impute.drop_critical(before, ["amount", "time"]), ["card_type", "city"])
    return completeness.missing_before_after(before, after)


@query("a_p4_missing_pattern", DIRTY + f"""SELECT {', '.join(f"({c} IS NULL OR {c} = '')::int AS {c}" for c in RAW_COLUMNS)},
  count(*) AS row_count FROM dirty GROUP BY ALL""")
def _(spark, folder):
    return completeness.missing_pattern(raw(spark, folder))


def _profile(name, source, column, sql_source):
    @query(name, f"""{sql_source} SELECT CASE WHEN {column} IS NULL THEN '<NULL>' WHEN trim({column}) = '' THEN '<BLANK>'
      ELSE trim({column}) END AS {column}, count(*) AS row_count,
      round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct_of_total_rows FROM {source} GROUP BY 1""")
    def _(spark, folder):
        df = dirty(spark, folder) if source == "dirty" else table(spark, folder, source)
        return consistency.value_profile(df, column)


for _c in ("status", "card_type", "city"):
    _profile(f"a_p5_value_profile_{_c}", "dirty", _c, DIRTY)
_profile("a_p5_value_profile_priority", "orders", "o_orderpriority", "")
_profile("a_p5_value_profile_source", "documents", "source", "")


_KIND = f"""CASE WHEN coalesce(trim(amount), '') = '' THEN 'NULL' WHEN ({number_sql('amount', False)}) IS NULL THEN 'non_numeric'
  WHEN ({number_sql('amount', False)}) % 1 = 0 THEN 'integer' ELSE 'decimal' END"""


@query("a_p6_amount_format_type", DIRTY + f"""SELECT {_KIND} AS amount_format_type, count(*) AS row_count,
  round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct_of_total_rows FROM dirty GROUP BY 1""")
def _(spark, folder):
    return consistency.number_kind_profile(dirty(spark, folder), "amount")


@query("a_p7_samples_per_group", DIRTY + f"""SELECT k, amount, {_KIND} AS amount_format_type,
  row_number() OVER (PARTITION BY {_KIND} ORDER BY k) AS sample_no FROM dirty QUALIFY sample_no <= 20""")
def _(spark, folder):
    df = dirty(spark, folder).select("k", "amount")
    return consistency.samples_per_group(df, formats.number_kind(F.col("amount")), "amount_format_type", ["k"])


_F1 = r"coalesce(regexp_full_match(trim(time), '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}'), false)"
_F2 = r"coalesce(regexp_full_match(trim(time), '\d{2}:\d{2} \d{4}-\d{2}-\d{2}'), false)"
_V1 = f"({_F1} AND try_strptime(trim(time), '%Y-%m-%d %H:%M:%S') IS NOT NULL)"
_V2 = f"({_F2} AND try_strptime(trim(time), '%H:%M %Y-%m-%d') IS NOT NULL)"


@query("a_p8_time_format_check", DIRTY + f"""SELECT 'valid' AS status, count(*) FILTER ({_V1}) AS row_count FROM dirty
UNION ALL SELECT 'invalid', count(*) FILTER (NOT {_V1}) FROM dirty""")
def _(spark, folder):
    return consistency.time_format_check(dirty(spark, folder), "time")


@query("a_p8_time_format_examples", DIRTY + f"SELECT k, time FROM dirty WHERE NOT {_V1} ORDER BY k LIMIT 50")
def _(spark, folder):
    return consistency.time_format_examples(dirty(spark, folder), "time", ["k"])


_DT = f"""CASE WHEN coalesce(trim(time), '') = '' THEN 'NULL' WHEN {_V1} OR {_V2} THEN 'valid'
  WHEN {_F1} OR {_F2} THEN 'impossible_date_or_time' ELSE 'invalid' END"""


def _summary(expression: str, statuses: list[str]) -> str:
    return unpivot_counts("dirty", [
        (f"'{s}'", f"count(*) FILTER (({expression}) = '{s}')", f"round(count(*) FILTER (({expression}) = '{s}') / count(*) * 100, 2)")
        for s in statuses], ("status", "row_count", "pct_of_total_rows"))


@query("a_p9_datetime_accuracy", DIRTY + _summary(_DT, ["valid", "impossible_date_or_time", "invalid", "NULL"]))
def _(spark, folder):
    return accuracy.datetime_accuracy(dirty(spark, folder), "time")


@query("a_p9_format_split", DIRTY + f"""SELECT CASE WHEN {_V1} THEN 'YYYY-MM-DD HH:MM:SS' ELSE 'HH:MM YYYY-MM-DD' END AS valid_format,
  count(*) AS row_count FROM dirty WHERE {_V1} OR {_V2} GROUP BY 1""")
def _(spark, folder):
    return accuracy.datetime_format_split(dirty(spark, folder), "time")


@query("a_p9_impossible_examples", DIRTY + f"""SELECT k, time FROM dirty WHERE {_DT} = 'impossible_date_or_time' ORDER BY k LIMIT 50""")
def _(spark, folder):
    df = dirty(spark, folder).select("k", "time")
    return accuracy.status_examples(df, accuracy.datetime_status(F.col("time")), "impossible_date_or_time", ["k"])


_AMOUNT = f"""CASE WHEN coalesce(trim(amount), '') = '' THEN 'NULL' WHEN abs({number_sql('amount')}) > 0 THEN 'valid' ELSE 'invalid' END"""


@query("a_p10_amount_accuracy", DIRTY + _summary(_AMOUNT, ["valid", "invalid", "NULL"]))
def _(spark, folder):
    return accuracy.amount_accuracy(dirty(spark, folder), "amount")


@query("a_p10_amount_detail", DIRTY + f"""
SELECT 'Non-numeric amount rows' AS metric, count(*) FILTER (coalesce(trim(amount), '') <> '' AND ({number_sql('amount')}) IS NULL) AS value FROM dirty
UNION ALL SELECT 'Negative amounts (converted to positive)', count(*) FILTER (({number_sql('amount')}) < 0) FROM dirty""")
def _(spark, folder):
    return accuracy.amount_accuracy_detail(dirty(spark, folder), "amount")


@query("a_p10_invalid_amounts", DIRTY + f"SELECT k, amount FROM dirty WHERE {_AMOUNT} = 'invalid' ORDER BY k LIMIT 50")
def _(spark, folder):
    df = dirty(spark, folder).select("k", "amount")
    return accuracy.status_examples(df, accuracy.amount_status(F.col("amount")), "invalid", ["k"])


@query("a_p10_balance_accuracy", """SELECT s.status, count(c_custkey) AS row_count,
  round(count(c_custkey) / (SELECT count(*) FROM customer) * 100, 2) AS pct_of_total_rows
FROM (VALUES ('valid'), ('invalid'), ('NULL')) s(status) LEFT JOIN customer
  ON s.status = CASE WHEN c_acctbal IS NULL THEN 'NULL' WHEN abs(c_acctbal) > 0 THEN 'valid' ELSE 'invalid' END GROUP BY 1""")
def _(spark, folder):
    balances = table(spark, folder, "customer").select(F.col("c_acctbal").cast("string").alias("balance"))
    return accuracy.amount_accuracy(balances, "balance")


_HOUR = r"""TRY_CAST(nullif(regexp_extract(trim(time), '^(\d{2}):\d{2}\s\d{4}-\d{2}-\d{2}$', 1)
  || regexp_extract(trim(time), '^\d{4}-\d{2}-\d{2}\s(\d{2}):\d{2}:\d{2}$', 1), '') AS int)"""


@query("a_p11_hour_extract", DIRTY + f"""SELECT count({_HOUR}) AS hours_collected, count(*) FILTER ({_HOUR} > 24) AS hours_over_24 FROM dirty""")
def _(spark, folder):
    return accuracy.hour_summary(dirty(spark, folder), "time")


@query("a_p11_hour_histogram", DIRTY + f"SELECT {_HOUR} AS hour, count(*) AS row_count FROM dirty WHERE {_HOUR} IS NOT NULL GROUP BY 1")
def _(spark, folder):
    return accuracy.hour_histogram(dirty(spark, folder), "time")


# The layouts that the derived times can have.
_TIME_CLASSES = [(n, p.strip("^$")) for n, p in TIME_LAYOUTS if "/" not in n]


def class_sql(column: str, classes, other: str = "OTHER") -> str:
    cases = " ".join(f"WHEN regexp_full_match(trim({column}), '{p}') THEN '{n}'" for n, p in classes)
    return f"""CASE WHEN coalesce(trim({column}), '') = '' OR upper(trim({column})) = 'NULL' THEN 'NULL/empty'
      {cases} ELSE '{other}' END"""


TIME_CLASS = class_sql("time", _TIME_CLASSES)
AMOUNT_CLASS = class_sql("amount", [("integer", r"-?\d+"), ("decimal", r"-?\d+\.\d+"), ("comma-number", r"-?\d{1,3}(,\d{3})+(\.\d+)?")], "text/other")


@query("a_p12_classify_time", CLEAN + f"SELECT k, time, {TIME_CLASS} AS time_class FROM clean")
def _(spark, folder):
    df = timed(spark, folder)
    return df.select("k", "time", formats.classify_time(F.col("time")).alias("time_class"))


@query("a_p12_classify_amount", DIRTY + f"SELECT k, amount, {AMOUNT_CLASS} AS amount_class FROM dirty")
def _(spark, folder):
    return dirty(spark, folder).select("k", "amount", formats.classify_amount(F.col("amount")).alias("amount_class"))


@query("a_p13_is_null_like", CLEAN + unpivot_counts("clean", [
    (f"'{c}'", f"count(*) FILTER ({c} IS NULL OR trim({c}) = '' OR upper(trim({c})) = 'NULL')") for c in RAW_COLUMNS],
    ('"column"', "null_like_rows")))
def _(spark, folder):
    table_of = completeness.null_table(cleansed(spark, folder).select(*RAW_COLUMNS), "clean")
    return table_of.select("column", F.col("null_count").alias("null_like_rows"))


_IN = "count(*) FILTER"


@query("b_p14_profile_document", DIRTY + f""", twins AS (
  SELECT coalesce(sum(n), 0) AS s FROM (SELECT count(*) AS n FROM dirty GROUP BY {', '.join(RAW_COLUMNS)} HAVING count(*) > 1)),
ids AS (SELECT coalesce(sum(n), 0) AS s FROM (SELECT count(*) AS n FROM dirty GROUP BY id HAVING count(*) > 1))
SELECT count(*) AS rows, 6::bigint AS cols, {', '.join(f'{_missing(c)} AS missing_{c}' for c in RAW_COLUMNS)},
  (SELECT s FROM twins)::bigint AS exact_duplicate_rows, (SELECT s FROM ids)::bigint AS duplicated_id_rows,
  {_IN} ({_DT} = 'valid') AS valid_time_rows, {_IN} ({_DT} IN ('invalid', 'impossible_date_or_time')) AS invalid_time_rows,
  {_IN} ({_DT} = 'NULL') AS null_time_rows, {_IN} ({_AMOUNT} = 'valid') AS valid_amount_rows,
  {_IN} ({_AMOUNT} = 'invalid') AS invalid_amount_rows, {_IN} ({_AMOUNT} = 'NULL') AS null_amount_rows FROM dirty""")
def _(spark, folder):
    document = tx.profile_document(raw(spark, folder))
    missing = [F.col("missing_by_col")[c].alias(f"missing_{c}") for c in RAW_COLUMNS]
    return document.select("*", *missing).drop("missing_by_col")


# --- outliers ----------------------------------------------------------------------

def _bounds_sql(x: str, source: str, where: str) -> str:
    return f"""SELECT n, round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
  round(q1 - 1.5 * (q3 - q1), 4) AS lower, round(q3 + 1.5 * (q3 - q1), 4) AS upper
  FROM (SELECT count({x}) AS n, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {source} WHERE {where})"""


def _rounded(df):
    return df.select(*[F.round(c, 4).alias(c) if t == "double" else c for c, t in df.dtypes])


@query("a_o1_iqr_bounds", CLEAN + _bounds_sql("abs(number)", "parts", "abs(number) > 0"))
def _(spark, folder):
    return _rounded(outliers.iqr_bounds(dirty(spark, folder), to_number(F.col("amount"))))


@query("a_o1_iqr_bounds_signed", CLEAN + _bounds_sql("number", "parts", "number IS NOT NULL"))
def _(spark, folder):
    return _rounded(outliers.iqr_bounds(dirty(spark, folder), to_number(F.col("amount")), outliers.SIGNED))


@query("a_o1_iqr_bounds_by_range", _bounds_sql("value", "events", "value > 0"))
def _(spark, folder):
    return _rounded(outliers.iqr_bounds(table(spark, folder, "events"), "value"))


@query("a_o1_quantiles_by_range_grouped", """SELECT l_returnflag, l_linestatus, count(*) AS n,
  round(quantile_cont(l_extendedprice, 0.1), 4) AS q0, round(quantile_cont(l_extendedprice, 0.5), 4) AS q1,
  round(quantile_cont(l_extendedprice, 0.99), 4) AS q2 FROM lineitem GROUP BY ALL""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    by = ["l_returnflag", "l_linestatus"]
    return _rounded(exact_quantiles(lines, "l_extendedprice", [0.1, 0.5, 0.99], by))


@query("a_o2_iqr_report", CLEAN + f""", b AS ({_bounds_sql('number', 'parts', 'number IS NOT NULL')}),
e AS (SELECT quantile_cont(number, 0.25) AS x1, quantile_cont(number, 0.75) AS x3 FROM parts)
SELECT q1, q3, iqr, lower, upper,
  (SELECT count(*) FROM parts, e WHERE number < x1 - 1.5 * (x3 - x1) OR number > x3 + 1.5 * (x3 - x1)) AS outlier_rows,
  (SELECT count(*) FROM parts, e WHERE number BETWEEN x1 - 1.5 * (x3 - x1) AND x3 + 1.5 * (x3 - x1)) AS non_outlier_rows FROM b""")
def _(spark, folder):
    staged = dirty(spark, folder).select(to_number(F.col("amount")).alias("x"))
    return _rounded(outliers.iqr_report(staged, "x"))


@query("a_o2_outlier_samples", CLEAN + """, e AS (SELECT quantile_cont(number, 0.25) AS x1, quantile_cont(number, 0.75) AS x3 FROM parts)
SELECT k, number FROM parts, e WHERE number < x1 - 1.5 * (x3 - x1) OR number > x3 + 1.5 * (x3 - x1) ORDER BY k LIMIT 50""")
def _(spark, folder):
    staged = dirty(spark, folder).select("k", to_number(F.col("amount")).alias("number"))
    return outliers.outlier_samples(staged, "number", ["k"])


_CROSS = [("valid", "NOT amount_nulled AND abs(number) > 0"),
          ("invalid", "coalesce(amount, '') <> '' AND NOT (NOT amount_nulled AND coalesce(abs(number), 0) > 0)"),
          ("NULL", "coalesce(amount, '') = ''")]


@query("a_o3_status_outlier_crosstab", CLEAN + " UNION ALL ".join(
    f"""SELECT '{s}' AS amount_status, count(*) FILTER (amount_nulled) AS outlier,
    count(*) FILTER (NOT amount_nulled AND number IS NOT NULL) AS non_outlier,
    count(*) FILTER (NOT amount_nulled AND number IS NULL) AS not_numeric_or_null FROM salvaged WHERE {w}""" for s, w in _CROSS))
def _(spark, folder):
    return outliers.status_outlier_crosstab(dirty(spark, folder), "amount")


# --- duplicates --------------------------------------------------------------------

_IDS = ", ids AS (SELECT trim(id) AS id, count(*) AS n FROM dirty WHERE trim(id) <> '' GROUP BY 1)"


@query("a_d1_duplicate_id_summary", DIRTY + _IDS + """, s AS (SELECT (SELECT count(*) FROM dirty) AS r,
  coalesce(sum(n), 0) AS i, coalesce(sum(n) FILTER (n > 1), 0) AS d FROM ids)
SELECT 'Total rows' AS metric, r::double AS value FROM s UNION ALL SELECT 'Rows with null/blank ID', (r - i)::double FROM s
UNION ALL SELECT 'Rows with non-null ID', i::double FROM s UNION ALL SELECT 'Rows with duplicated ID', d::double FROM s
UNION ALL SELECT 'Duplicate ID rate (%) over non-null IDs', CASE WHEN i = 0 THEN 0.0 ELSE round(d / i * 100, 2) END::double FROM s""")
def _(spark, folder):
    return duplicates.duplicate_id_summary(dirty(spark, folder), "id")


@query("a_d1_lineitem_orders", """WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
s AS (SELECT sum(n) AS r, coalesce(sum(n) FILTER (n > 1), 0) AS d FROM n)
SELECT 'Total rows' AS metric, r::double AS value FROM s UNION ALL SELECT 'Rows with null/blank ID', 0.0::double
UNION ALL SELECT 'Rows with non-null ID', r::double FROM s UNION ALL SELECT 'Rows with duplicated ID', d::double FROM s
UNION ALL SELECT 'Duplicate ID rate (%) over non-null IDs', round(d / r * 100, 2)::double FROM s""")
def _(spark, folder):
    return duplicates.duplicate_id_summary(table(spark, folder, "lineitem"), "l_orderkey")


@query("a_d2_repeated_ids", DIRTY + _IDS + "SELECT id, n AS duplicate_count FROM ids WHERE n > 1")
def _(spark, folder):
    return duplicates.repeated_ids(dirty(spark, folder), "id")


@query("a_d2_top_repeated_ids", """SELECT CAST(l_orderkey AS varchar) AS l_orderkey, count(*) AS duplicate_count FROM lineitem
GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def _(spark, folder):
    return duplicates.repeated_ids(table(spark, folder, "lineitem"), "l_orderkey", top=15)


@query("a_d3_exact_duplicate_groups", """SELECT text, lang, source, n_chars, count(*) AS duplicate_count FROM documents
GROUP BY ALL HAVING count(*) > 1""")
def _(spark, folder):
    return duplicates.duplicate_row_groups(table(spark, folder, "documents").drop("doc_id"))


@query("a_d3_duplicate_members", """SELECT doc_id, text, lang FROM documents
QUALIFY count(*) OVER (PARTITION BY text, lang) > 1""")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return duplicates.duplicate_row_members(docs, ["text", "lang"])


@query("a_d3_duplicate_summary", """WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT 'Total rows' AS metric, (SELECT count(*) FROM lineitem) AS value
UNION ALL SELECT 'Rows that are part of exact duplicate groups', coalesce(sum(n), 0)::bigint FROM g
UNION ALL SELECT 'Unique exact duplicate row patterns', count(*) FROM g""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return duplicates.duplicate_row_summary(lines, ["l_orderkey", "l_linenumber"])


@query("a_d4_id_value_distribution", """WITH n AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (n = 1) AS unique_id_values, count(*) FILTER (n > 1) AS duplicated_id_values FROM n""")
def _(spark, folder):
    return duplicates.id_value_distribution(table(spark, folder, "lineitem"), "l_partkey")


@query("a_d5_duplicated_with_nulls", DIRTY + """SELECT coalesce(sum(n), 0)::bigint AS duplicated_rows
FROM (SELECT count(*) AS n FROM dirty GROUP BY city HAVING count(*) > 1)""")
def _(spark, folder):
    return duplicates.duplicated_rows_by_key(dirty(spark, folder), "city")
