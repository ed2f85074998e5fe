"""Sources, sinks, cleansing, canonicalisation and normalisation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from checks.base import (
    CARD_SQL, CITY_SQL, CLEAN, CLOCK_SQL, DAY_SQL, DIRTY, DONE, MAX_YEAR, RAW_COLUMNS, STATUS_SQL,
    dirty, number_sql, parse_sql, query, raw, table, unpivot_counts,
)
from mendwork.functions import datetimes, numeric
from mendwork.functions.fixed_values import CARD_MAP, CITY_MAP, MONTH_MAP, STATUS_MAP
from mendwork.functions.mapping import canonical
from mendwork.functions.nulls import NullPolicy, is_missing
from mendwork.operators import canonical as canon
from mendwork.operators import impute, keys, outliers, star
from mendwork.operators.report import spread
from mendwork.plans import transactions as tx
from mendwork.session import materialise, shared_folder
from mendwork.sources import delimited, publish, readers, sinks

OPTIONS = tx.Options(order_by=["k"], max_year=MAX_YEAR)


def cleansed(spark, folder) -> DataFrame:
    return tx.cleanse(dirty(spark, folder), OPTIONS)


def timed(spark, folder) -> DataFrame:
    """Key and salvaged time; the amounts are not looked at."""
    stripped = tx.strip_columns(dirty(spark, folder).select("k", "time"), ["time"])
    return tx.cleanse_time(stripped, OPTIONS)


def measured(spark, folder) -> DataFrame:
    """Key and amount without outliers; the times are not looked at."""
    stripped = tx.strip_columns(dirty(spark, folder).select("k", "amount"), ["amount"])
    return tx.cleanse_amount(materialise(stripped, "amounts"))


def transformed(spark, folder) -> DataFrame:
    """Cleansed, transformed and normalised, without the surrogate key."""
    parsed = tx.parse_amount(tx.cleanse_time(tx.strip_columns(dirty(spark, folder)), OPTIONS))
    rows = tx.null_amount_outliers(materialise(parsed, "transactions"))
    return tx.normalise_columns(tx.transform(rows, OPTIONS))


# --- sources and sinks -------------------------------------------------------------

@query("a_s1_load_typed", """
SELECT CAST(doc_id AS varchar) AS doc_id, text, lang, source, CAST(n_chars AS varchar) AS n_chars
FROM documents""")
def _(spark, folder):
    path = f"{folder}/documents.parquet"
    loaded = readers.read_table(spark, path, "parquet", ["doc_id", "text", "lang"], policy=None)
    return readers.as_text(loaded)


def place(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_NA = "'', 'NULL', 'null', 'NA', 'N/A', 'n/a', 'None', 'nan', 'NaN', '<NA>', '#N/A'"


@query("a_s1_load_csv", DIRTY + "SELECT " + ", ".join(
    f"CASE WHEN {c} NOT IN ({_NA}) THEN {c} END AS {c}" for c in RAW_COLUMNS) + " FROM dirty")
def _(spark, folder):
    path = place(spark, "raw")
    sinks.write_csv(dirty(spark, folder).select("k", *RAW_COLUMNS), path)
    return readers.load_transactions(spark, path).select(*RAW_COLUMNS)


# Lines of a file by the remainder of k: quotes, a line break, a quote in a plain cell, short, too long, too long with quotes, empty cells.
_LINES = (
    'concat(k, \',"Te ""q"" hran","a, b",\', k)',
    "concat(k, ',\"two', chr(10), 'lines\", lead ,', k)",
    "concat(k, ',Vi\"sa, x y ,')",
    "concat(k, ',short')",
    "concat(k, ',a,b,', k, ',more,')",
    "concat(k, ',\"a, b\",\"c, \"\"d\",1,2')",
    "concat(k, ',,\"\",', k)",
)
_PLAIN_CELLS = {
    "a": ("'Te \"q\" hran'", "concat('two', chr(10), 'lines')", "'Vi\"sa'", "'short'", None, None, "''"),
    "b": ("'a, b'", "' lead '", "' x y '", "NULL", None, None, "''"),
    "c": ("CAST(o_orderkey AS varchar)", "CAST(o_orderkey AS varchar)", "''", "NULL", None, None, "CAST(o_orderkey AS varchar)"),
}


def _odd_lines(spark, folder):
    """A file of such lines, one for every order."""
    number = F.col("k") % len(_LINES)
    lines = [F.when(number == i, F.expr(line)) for i, line in enumerate(_LINES)]
    path = place(spark, "lines")
    table(spark, folder, "orders").select(F.col("o_orderkey").alias("k")).select(F.coalesce(*lines).alias("value")).write.text(path)
    return delimited.read_parted(spark, path, columns=["k", "a", "b", "c"])


def _by_remainder(values) -> str:
    cases = [f"WHEN {i} THEN {v}" for i, v in enumerate(values) if v is not None]
    return f"CASE o_orderkey % {len(_LINES)} {' '.join(cases)} END"


@query("a_s1_load_csv_quoted", "SELECT CAST(o_orderkey AS varchar) AS k, " + ", ".join(
    f"{_by_remainder(v)} AS {c}" for c, v in _PLAIN_CELLS.items()) + f" FROM orders WHERE o_orderkey % {len(_LINES)} NOT IN (4, 5)")
def _(spark, folder):
    return _odd_lines(spark, folder).rows


@query("a_s1_quarantine", f"""
SELECT o_orderkey || CASE o_orderkey % {len(_LINES)} WHEN 4 THEN ',a,b,' || o_orderkey || ',more,' ELSE ',"a, b","c, ""d",1,2' END AS row_text,
  CASE o_orderkey % {len(_LINES)} WHEN 4 THEN 6 ELSE 5 END AS n_fields, 4 AS expected_fields, 'too many fields' AS problem
FROM orders WHERE o_orderkey % {len(_LINES)} IN (4, 5)""")
def _(spark, folder):
    return _odd_lines(spark, folder).quarantine.drop("file")


_POLICY_ROWS = [
    (
        f"'{c}'",
        f"count(*) FILTER ({c} IS NULL)",
        f"count(*) FILTER ({c} IS NULL OR {c} IN ('', 'NULL', 'null', 'NA', 'N/A', 'n/a', 'None', 'nan', 'NaN', '<NA>', '#N/A'))",
        f"count(*) FILTER ({c} IS NULL OR trim({c}) = '')",
        f"count(*) FILTER ({c} IS NULL OR trim({c}) = '' OR upper(trim({c})) = 'NULL')",
    )
    for c in RAW_COLUMNS
]


@query(
    "a_s2_null_tokens",
    CLEAN + unpivot_counts(
        "clean", _POLICY_ROWS, ('"column"', "strict", "na_tokens", "blank", "null_like")
    ),
)
def _(spark, folder):
    df = cleansed(spark, folder).select(*RAW_COLUMNS)
    policies = list(NullPolicy)
    counts = df.agg(
        *[F.count_if(is_missing(df, c, p)).alias(f"{c}_{p.value}") for c in df.columns for p in policies]
    )
    rows = [(F.lit(c), *[F.col(f"{c}_{p.value}") for p in policies]) for c in df.columns]
    return spread(counts, ["column", *[p.value for p in policies]], rows)


@query("a_s3_required_id", """
SELECT 'o_orderkey' AS id_column, count(*) AS row_count, count(o_orderkey) AS id_rows FROM orders""")
def _(spark, folder):
    df = readers.require_id_column(table(spark, folder, "orders"), "o_orderkey")
    counts = df.agg(F.count("*").alias("row_count"), F.count("o_orderkey").alias("id_rows"))
    return counts.withColumn("id_column", F.lit("o_orderkey"))


@query("a_s4_export_cleansed", CLEAN + """
SELECT id, coalesce(nullif(status, ''), 'NULL') AS status, time,
  coalesce(nullif(card_type, ''), 'NULL') AS card_type, coalesce(nullif(city, ''), 'NULL') AS city,
  coalesce(nullif(amount, ''), 'NULL') AS amount FROM clean""")
def _(spark, folder):
    return sinks.cleansed_view(cleansed(spark, folder))


@query("a_s5_export_transformed", DONE + """
SELECT id, transaction_id, coalesce(status_clean, 'NULL') AS status,
  coalesce(date_clean, 'NULL') AS date, coalesce(clock_time_clean, 'NULL') AS time,
  coalesce(card_type_clean, 'NULL') AS card_type, coalesce(city_clean, 'NULL') AS city,
  coalesce(CAST(amount_clean AS varchar), 'NULL') AS amount FROM done""")
def _(spark, folder):
    return sinks.transformed_view(tx.run(dirty(spark, folder), OPTIONS).frame)


@query("a_s6_lookup_load", DIRTY + f""", named AS (SELECT {CITY_SQL} AS city FROM dirty),
ids AS (SELECT city, 'city_' || row_number() OVER (ORDER BY city) AS city_id
        FROM (SELECT DISTINCT city FROM named WHERE city IS NOT NULL))
SELECT ids.city, city_id, count(*) AS row_count FROM named JOIN ids ON named.city = ids.city
GROUP BY ALL""")
def _(spark, folder):
    # The lookup is made from the data, written as a file and read again.
    path = place(spark, "city")
    named = dirty(spark, folder).select(canonical(F.col("city"), CITY_MAP).alias("city"))
    sinks.write_csv(star.extract_dimension(named, "city", "city_id", "city_").table, path)
    counts = named.groupBy("city").agg(F.count("*").alias("row_count"))
    return counts.join(readers.read_lookup(spark, path), "city")


@query("b_s7_metadata_document", DONE + """, med AS (
  SELECT median(amount_clean) AS m FROM done WHERE amount_clean > 0)
SELECT count(*) FILTER (status_invalid_flag) AS status_unmapped_non_null_to_null,
  count(*) FILTER (card_type_invalid_flag) AS card_type_unmapped_non_null_to_null,
  count(*) FILTER (city_invalid_flag) AS city_unmapped_non_null_to_null,
  count(*) FILTER (time_valid_flag) AS time_parsed_valid_rows,
  count(*) FILTER (NOT time_valid_flag) AS time_parsed_invalid_or_null_rows,
  count(*) FILTER (coalesce(amount_clean, 0) <= 0) AS amount_invalid_or_null_rows_imputed,
  round((SELECT m FROM med), 4) AS amount_global_median_used FROM done""")
def _(spark, folder):
    document = tx.metadata_document(transformed(spark, folder)).select("transforms.*")
    return document.withColumn("amount_global_median_used", F.round("amount_global_median_used", 4))


def written_star(spark, folder) -> dict[str, DataFrame]:
    """The star's tables, written to a folder each and read back."""
    path = place(spark, "star")
    tables = tx.star(tx.run(dirty(spark, folder), OPTIONS).frame, OPTIONS)
    sinks.write_tables(tables, path)
    return {name: readers.read_table(spark, f"{path}/{name}", "parquet", t.columns, policy=None) for name, t in tables.items()}


@query("b_s8_tables_read_back", DONE + """
SELECT transaction_id, status_clean AS status, date_clean AS date, clock_time_clean AS time,
  card_type_clean AS card_type, city_clean AS city, amount_clean AS amount FROM done""")
def _(spark, folder):
    tables = written_star(spark, folder)
    wide = tables["fact"].join(tables["card"], "card_id", "left").join(tables["city"], "city_id", "left")
    return wide.select("transaction_id", "status", "date", "time", "card_type", "city", "amount")


@query("b_s8_multi_table", DONE + """
SELECT 'fact' AS table_name, count(*) AS row_count, 7::bigint AS column_count FROM done
UNION ALL SELECT 'card', count(DISTINCT card_type_clean), 2 FROM done
UNION ALL SELECT 'city', count(DISTINCT city_clean), 2 FROM done""")
def _(spark, folder):
    tables = written_star(spark, folder)
    sizes = star.row_preservation(list(tables.items())).withColumnRenamed("stage", "table_name")
    widths = F.create_map(*[x for n, t in tables.items() for x in (F.lit(n), F.lit(len(t.columns)))])
    return sizes.withColumn("column_count", F.try_element_at(widths, F.col("table_name")).cast("long"))


@query("b_s8_published_run", DONE + """
SELECT transaction_id, status_clean AS status, date_clean AS date, clock_time_clean AS time,
  card_type_clean AS card_type, city_clean AS city FROM done""")
def _(spark, folder):
    path = place(spark, "published")
    frame = tx.run(dirty(spark, folder), OPTIONS).frame
    for fmt in ("parquet", "csv"):
        publish.publish(tx.star(frame, OPTIONS), path, fmt)
    tables = publish.read_published(spark, path, verify=True)
    wide = tables["fact"].join(tables["card"], "card_id", "left").join(tables["city"], "city_id", "left")
    return wide.select("transaction_id", "status", "date", "time", "card_type", "city")


@query("b_s9_first_rows", DIRTY + "SELECT * FROM dirty ORDER BY k LIMIT 500")
def _(spark, folder):
    return readers.first_rows(dirty(spark, folder), ["k"], 500)


# --- cleansing ---------------------------------------------------------------------

@query("a_c1_strip_text", CLEAN + "SELECT * FROM stripped")
def _(spark, folder):
    return tx.strip_columns(dirty(spark, folder))


@query("a_c2_parse_mixed_datetime", DIRTY + f"""
SELECT k, time, strftime({parse_sql('trim(time)')}, '%Y-%m-%d %H:%M:%S') AS parsed FROM dirty""")
def _(spark, folder):
    df = dirty(spark, folder).select("k", "time")
    parsed = datetimes.with_parsed_datetime(df, "time", "parsed", MAX_YEAR)
    return parsed.withColumn("parsed", datetimes.iso_stamp(F.col("parsed")))


@query("a_c3_first_valid_date", DIRTY + f"SELECT k, time, replace({DAY_SQL}, '/', '-') AS day FROM dirty")
def _(spark, folder):
    day = datetimes.first_valid_date(F.col("time"), MAX_YEAR)
    return dirty(spark, folder).select("k", "time", day.alias("day"))


@query("a_c4_first_valid_clock", DIRTY + f"SELECT k, time, left({CLOCK_SQL}, 5) AS clock FROM dirty")
def _(spark, folder):
    clock = datetimes.first_valid_clock(F.col("time"))
    return dirty(spark, folder).select("k", "time", clock.alias("clock"))


@query("a_c5_salvage_time_text", CLEAN + "SELECT k, time_text AS time, time_formatted FROM (SELECT *, time_text <> coalesce(time, '') AS time_formatted FROM salvaged)")
def _(spark, folder):
    df = tx.strip_columns(dirty(spark, folder).select("k", "time"), ["time"])
    staged = datetimes.with_parsed_datetime(df, "time", "_stamp", MAX_YEAR, stripped=True)
    text = datetimes.salvage_time_text(F.col("time"), MAX_YEAR, parsed=F.col("_stamp"))
    staged = staged.withColumn("_new", text)
    changed = F.col("_new") != F.coalesce("time", F.lit(""))
    return staged.select("k", F.col("_new").alias("time"), changed.alias("time_formatted"))


@query("a_c6_amount_text_fix", DIRTY + """
SELECT k, CASE WHEN lower(amount) = 'one hundred' THEN '100' ELSE amount END AS amount FROM dirty""")
def _(spark, folder):
    return dirty(spark, folder).select("k", numeric.replace_words(F.col("amount")).alias("amount"))


@query("a_c7_to_numeric_coerce", DIRTY + f"""
SELECT k, {number_sql('amount')} AS number, {number_sql('amount', False)} AS plain_number,
  {number_sql('time')} AS time_number FROM dirty""")
def _(spark, folder):
    return dirty(spark, folder).select(
        "k",
        numeric.to_number(F.col("amount")).alias("number"),
        numeric.to_number(F.col("amount"), None).alias("plain_number"),
        numeric.to_number(F.col("time")).alias("time_number"),
    )


@query("a_c8_abs_amount", "SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer")
def _(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", F.abs("c_acctbal").alias("c_acctbal"))


@query("a_c9_null_outliers", CLEAN + "SELECT k, amount, amount_nulled FROM clean")
def _(spark, folder):
    df = dirty(spark, folder).select("k", F.trim("amount").alias("amount"))
    flagged = outliers.with_outlier_flag(df, numeric.to_number(F.col("amount")), "amount_nulled")
    return flagged.withColumn("amount", F.when(~F.col("amount_nulled"), F.col("amount")))


@query("a_c9_null_outliers_events", """
WITH b1 AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events WHERE value > 0),
once AS (SELECT event_id, CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END AS value
         FROM events, b1),
b2 AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM once WHERE value > 0)
SELECT event_id, CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END AS value
FROM once, b2""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return outliers.null_outliers(events, "value", passes=2)


@query("a_c10_cleansing_phase", CLEAN + """
SELECT 'time_column_formatted_rows' AS metric, count(*) FILTER (time_formatted) AS value FROM clean
UNION ALL SELECT 'amount_outlier_nulled', count(*) FILTER (amount_nulled) FROM clean""")
def _(spark, folder):
    return tx.cleansing_counts(cleansed(spark, folder))


# --- canonical values --------------------------------------------------------------

def _canon_query(name, column, mapping, expression):
    sql = DIRTY + f"""SELECT k, {column}, {expression} AS {column}_clean,
      ({expression}) IS NULL AND coalesce(trim({column}), '') <> '' AS {column}_invalid_flag FROM dirty"""

    @query(name, sql)
    def _(spark, folder):
        return canon.canonicalise(dirty(spark, folder).select("k", column), column, mapping)


_canon_query("a_t1_map_status", "status", STATUS_MAP, STATUS_SQL)
_canon_query("a_t2_map_card_type", "card_type", CARD_MAP, CARD_SQL)
_canon_query("a_t3_map_city", "city", CITY_MAP, CITY_SQL)


@query("a_t3_map_by_table", """
SELECT event_id, event_type, event_type IN ('click', 'view', 'purchase') AS known,
  CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'VIEW' WHEN 'purchase' THEN 'PURCHASE' END AS event_type_clean,
  event_type NOT IN ('click', 'view', 'purchase') AS event_type_invalid_flag FROM events""")
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    lookup = (
        events.filter(F.col("event_type").isin("click", "view", "purchase"))
        .select("event_type")
        .distinct()
        .select(F.lower("event_type").alias("variant"), F.upper("event_type").alias("canonical"))
    )
    mapped = canon.canonicalise_by_table(events, "event_type", lookup)
    return mapped.withColumn("known", F.col("event_type_clean").isNotNull())


@query("a_t4_transform_time", DONE + "SELECT k, time, time_clean AS time_parsed, time_valid_flag, time_invalid_flag FROM done")
def _(spark, folder):
    done = tx.transform_time(timed(spark, folder).select("k", "time", "time_stamp"), OPTIONS)
    return done.withColumn("time_parsed", datetimes.iso_stamp(F.col("time_parsed")))


@query("a_t5_transform_amount", DONE + """SELECT k, amount, amount_non_numeric_flag,
  amount_negative_flag, amount_numeric, amount_outlier_flag FROM done""")
def _(spark, folder):
    return tx.transform_amount(measured(spark, folder).select("k", "amount", "amount_number"), OPTIONS)


_T6 = [
    (f"'{n}'", f"count(*) FILTER ({e})")
    for n, e in {
        "time_column_formatted_rows": "time_formatted",
        "amount_outlier_nulled": "amount_nulled",
        "status_invalid_rows": "status_invalid_flag",
        "time_valid_rows": "time_valid_flag",
        "time_invalid_rows": "time_invalid_flag",
        "card_type_invalid_rows": "card_type_invalid_flag",
        "city_invalid_rows": "city_invalid_flag",
        "amount_non_numeric_rows": "amount_non_numeric_flag",
        "amount_negative_rows": "amount_negative_flag",
        "amount_outlier_rows": "amount_outlier_flag",
        "status_clean_null_rows": "status_clean IS NULL",
        "card_type_clean_null_rows": "card_type_clean IS NULL",
        "city_clean_null_rows": "city_clean IS NULL",
        "time_null_rows": "coalesce(time, '') = ''",
    }.items()
]


@query("a_t6_transformation_phase", DONE + unpivot_counts("done", _T6, ("metric", "value")))
def _(spark, folder):
    return tx.phase_counts(tx.transform(cleansed(spark, folder), OPTIONS))


@query("a_t7_canonical_lookup", DIRTY + f""", r AS (
  SELECT DISTINCT trim(city) AS raw_city, {CITY_SQL} AS c FROM dirty WHERE coalesce(trim(city), '') <> ''),
ids AS (SELECT c, 'city_' || row_number() OVER (ORDER BY c) AS city_id FROM (SELECT DISTINCT c FROM r WHERE c IS NOT NULL))
SELECT raw_city, coalesce(r.c, 'NULL') AS canonical_city, coalesce(city_id, 'NULL') AS city_id
FROM r LEFT JOIN ids ON r.c = ids.c""")
def _(spark, folder):
    df = dirty(spark, folder)
    city = tx.city_dimension(df, OPTIONS)
    return canon.lookup_report(df, "city", CITY_MAP, city.table, city.name, city.id)


@query("b_t8_snake_case", "SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand, p_retailprice AS retail_price FROM part")
def _(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    return canon.snake_case_columns(part.toDF("Part Key", "partName", " Brand ", "Retail-Price"))


@query("b_t9_rescale", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 100 AS discount_pct,
  CASE WHEN l_quantity > 10 THEN l_quantity / 10 ELSE l_quantity END AS quantity_scaled,
  l_quantity > 10 AS rescaled FROM lineitem""")
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numeric.fraction_to_percent(F.col("l_discount")).alias("discount_pct"),
        numeric.rescale_above(F.col("l_quantity"), 10.0).alias("quantity_scaled"),
        (F.col("l_quantity") > 10).alias("rescaled"),
    )


@query("b_t10_round_to_step", """
SELECT p_partkey, round(p_retailprice / 0.5) * 0.5 AS price, CAST(round(p_retailprice) AS int) AS whole FROM part""")
def _(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        numeric.round_to_step(F.col("p_retailprice"), 0.5).alias("price"),
        numeric.round_to_step(F.col("p_retailprice")).cast("int").alias("whole"),
    )


_WIDE_SQL = "SELECT o_orderkey, o_orderstatus, 1500 AS calories_burned, 'IRR' AS currency FROM orders"


@query("b_t11_constant_columns", f"""WITH w AS ({_WIDE_SQL})
SELECT 'calories_burned' AS "column", CAST(min(calories_burned) AS varchar) AS value FROM w
HAVING count(DISTINCT calories_burned) = 1
UNION ALL SELECT 'currency', min(currency) FROM w HAVING count(DISTINCT currency) = 1
UNION ALL SELECT 'o_orderstatus', min(o_orderstatus) FROM w HAVING count(DISTINCT o_orderstatus) = 1""")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    wide = orders.withColumns({"calories_burned": F.lit(1500), "currency": F.lit("IRR")})
    return canon.constant_columns(wide)


@query("b_t11_drop_constant", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    wide = orders.withColumns({"calories_burned": F.lit(1500), "currency": F.lit("IRR")})
    return canon.drop_constant_columns(wide)[0]


@query("b_t12_nullable_boolean", """
SELECT doc_id, quality = 1 AS quality_flag,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE toxic = 1 END AS toxic_flag FROM labels""")
def _(spark, folder):
    toxic = F.when(F.col("doc_id") % 3 != 0, F.when(F.col("toxic") == 1, " Yes ").otherwise("FALSE"))
    return table(spark, folder, "labels").select(
        "doc_id",
        numeric.to_boolean(F.col("quality")).alias("quality_flag"),
        numeric.to_boolean(toxic).alias("toxic_flag"),
    )


@query("b_t13_date_parts", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_iso, year(ts)::int AS year, month(ts)::int AS month,
  hour(ts)::int AS txn_hour FROM events""")
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", datetimes.iso_day(F.col("ts")).alias("date_iso"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.hour("ts").alias("txn_hour"),
    )


@query("b_t14_month_names", """
SELECT monthname(o_orderdate) AS month, count(*) AS row_count FROM orders GROUP BY ALL""")
def _(spark, folder):
    name = F.date_format("o_orderdate", "MMMM")
    spelled = (
        F.when(F.col("o_orderkey") % 3 == 0, F.upper(F.left(name, F.lit(3))))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit(" "), F.lower(name)))
        .otherwise(name)
    )
    months = table(spark, folder, "orders").select(canonical(spelled, MONTH_MAP).alias("month"))
    return months.groupBy("month").agg(F.count("*").alias("row_count"))


@query("b_t14_band_check", """
WITH c AS (SELECT *, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS e,
  CASE WHEN c_nationkey % 5 = 0 THEN 'low' WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band
  FROM customer)
SELECT c_custkey, c_acctbal, band, e AS expected_label, band = e AS label_matches FROM c""")
def _(spark, folder):
    x = F.col("c_acctbal")
    band = (
        F.when(F.col("c_nationkey") % 5 == 0, "low").when(x < 0, "negative").when(x < 5000, "low").otherwise("high")
    )
    df = table(spark, folder, "customer").select("c_custkey", "c_acctbal", band.alias("band"))
    bands = [(0.0, "negative"), (5000.0, "low"), (None, "high")]
    return canon.range_label_check(df, "c_acctbal", "band", bands)


# --- imputation --------------------------------------------------------------------

@query("a_i1_drop_critical", DIRTY + """, n AS (
  SELECT count(*) AS a, count(*) FILTER (coalesce(amount, '') <> '' AND coalesce(time, '') <> '') AS b FROM dirty)
SELECT a AS rows_before, b AS rows_left, a - b AS rows_dropped FROM n""")
def _(spark, folder):
    return impute.drop_critical_count(dirty(spark, folder), ["amount", "time"])


@query("a_i2_fill_unknown", DIRTY + """
SELECT k, coalesce(card_type, 'Unknown') AS card_type, coalesce(city, 'Unknown') AS city FROM dirty
WHERE amount IS NOT NULL AND time IS NOT NULL""")
def _(spark, folder):
    kept = impute.drop_critical(dirty(spark, folder), ["amount", "time"])
    return impute.fill_unknown(kept, ["card_type", "city"]).select("k", "card_type", "city")


@query("b_i3_global_median", DONE + """, m AS (SELECT median(amount_numeric) AS med FROM done WHERE amount_numeric > 0)
SELECT k, round(CASE WHEN amount_numeric > 0 THEN amount_numeric ELSE med END, 4) AS amount_numeric,
  coalesce(amount_numeric, 0) <= 0 AS amount_numeric_imputed_flag FROM done, m""")
def _(spark, folder):
    staged = tx.transform_amount(measured(spark, folder).select("k", "amount", "amount_number"), OPTIONS)
    filled = impute.fill_median(staged, "amount_numeric", F.col("amount_numeric") > 0)
    return filled.select("k", F.round("amount_numeric", 4).alias("amount_numeric"), "amount_numeric_imputed_flag")


# --- normalisation -----------------------------------------------------------------

@query("a_n1_split_timestamp", DONE + "SELECT k, time_clean, date_clean, clock_time_clean FROM done")
def _(spark, folder):
    done = tx.transform_time(timed(spark, folder).select("k", "time", "time_stamp"), OPTIONS)
    stamp = F.col("time_parsed")
    return done.select(
        "k", datetimes.iso_stamp(stamp).alias("time_clean"),
        datetimes.iso_day(stamp).alias("date_clean"), datetimes.iso_clock(stamp).alias("clock_time_clean"),
    )


@query("a_n2_amount_clean", DONE + "SELECT k, amount_clean FROM done")
def _(spark, folder):
    staged = tx.transform_amount(measured(spark, folder).select("k", "amount", "amount_number"), OPTIONS)
    return staged.select("k", F.when(~F.col("amount_outlier_flag"), F.col("amount_numeric")).alias("amount_clean"))


@query("a_n3_normalisation_phase", DONE + """
SELECT k, transaction_id, time_clean, date_clean, clock_time_clean, amount_clean FROM done""")
def _(spark, folder):
    frame = tx.after_cleansing(cleansed(spark, folder), OPTIONS)
    return frame.select("k", "transaction_id", "time_clean", "date_clean", "clock_time_clean", "amount_clean")


@query("a_n4_surrogate_key", DIRTY + "SELECT k, id, printf('TRX_%05d', row_number() OVER (ORDER BY k)) AS transaction_id FROM dirty")
def _(spark, folder):
    return keys.add_surrogate_key(dirty(spark, folder).select("k", "id"), ["k"])


@query("a_n4_surrogate_key_sliced", """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders""")
def _(spark, folder):
    # More ranges than the tables' size asks for.
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return keys.add_surrogate_key(orders, ["o_orderdate", "o_orderkey"], "row_id", None, slices=24)


@query("b_n5_extract_dimension", """
SELECT o_orderpriority, 'priority_' || row_number() OVER (ORDER BY o_orderpriority) AS priority_id
FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def _(spark, folder):
    orders = table(spark, folder, "orders")
    return star.extract_dimension(orders, "o_orderpriority", "priority_id", "priority_").table


@query("b_n6_star_fact", DONE + """, cards AS (SELECT c, 'card_' || row_number() OVER (ORDER BY c) AS card_id
  FROM (SELECT DISTINCT card_type_clean AS c FROM done WHERE card_type_clean IS NOT NULL)),
cities AS (SELECT c, 'city_' || row_number() OVER (ORDER BY c) AS city_id
  FROM (SELECT DISTINCT city_clean AS c FROM done WHERE city_clean IS NOT NULL))
SELECT transaction_id, status_clean AS status, date_clean AS date, clock_time_clean AS time,
  card_id, city_id, amount_clean AS amount
FROM done LEFT JOIN cards ON card_type_clean = cards.c LEFT JOIN cities ON city_clean = cities.c""")
def _(spark, folder):
    return tx.star(tx.run(dirty(spark, folder), OPTIONS).frame, OPTIONS)["fact"]


@query("a_n9_run_reengineering", DONE + """
SELECT id, transaction_id, status_clean AS status, date_clean AS date, clock_time_clean AS time,
  card_type_clean AS card_type, city_clean AS city, amount_clean AS amount FROM done""")
def _(spark, folder):
    return tx.run(dirty(spark, folder), OPTIONS).transformed


@query("a_n9_run_summary", DONE + unpivot_counts(
    "done", [*_T6, ("'amount_clean_null_rows'", "count(*) FILTER (amount_clean IS NULL)")], ("metric", "value")))
def _(spark, folder):
    return tx.run(dirty(spark, folder), OPTIONS).summary
