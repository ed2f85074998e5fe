"""Retail and calorie tables derived from orders and events, and their plans."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, functions as F

from checks.base import query, table
from mendwork.functions.numeric import to_boolean
from mendwork.operators import column_sets, impute
from mendwork.operators.completeness import structured_missingness
from mendwork.plans import calorie
from mendwork.plans import retail as plan
from mendwork.session import shared_folder
from mendwork.sources.sinks import write_document

# Columns that read the same in Spark SQL and DuckDB. Items are priced 5.0, 6.5, 8.0, …
# so that category and price determine the item.
_ITEM = "o_custkey % 25"
_PRICE = f"(5.0e0 + 1.5e0 * ({_ITEM}))"
_QUANTITY = "CAST(o_orderkey % 7 + o_custkey % 4 + 1 AS double)"
_NO_PRICE = "o_orderkey % 17 = 0"
_NO_QUANTITY = "o_orderkey % 19 = 0"


def _columns(day: str, text: str) -> str:
    return f"""o_orderkey AS k, o_orderpriority AS category,
    CASE WHEN {_NO_PRICE} OR o_orderkey % 13 = 0 THEN NULL
      ELSE concat('Item_', CAST({_ITEM} + 1 AS {text}), '_', left(o_orderpriority, 1)) END AS item,
    CASE WHEN NOT ({_NO_PRICE}) THEN {_PRICE} END AS price_per_unit,
    CASE WHEN NOT ({_NO_QUANTITY}) THEN {_QUANTITY} END AS quantity,
    CASE WHEN NOT ({_NO_QUANTITY}) THEN {_PRICE} * {_QUANTITY} END AS total_spent,
    {day} AS transaction_date,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 'True' ELSE 'False' END AS discount_applied,
    concat('CUST_', CAST(o_custkey % 25 + 1 AS {text})) AS customer,
    CASE WHEN o_orderkey % 5 < 2 THEN 'Cash' WHEN o_orderkey % 5 = 2 THEN 'Credit Card' ELSE 'Digital Wallet' END AS payment_method,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Online' ELSE 'In-store' END AS location"""


def sales(spark, folder) -> DataFrame:
    """Retail sales with gaps; names as they come from the till."""
    day = "date_format(o_orderdate, 'yyyy-MM-dd')"
    orders = table(spark, folder, "orders")
    df = spark.sql(f"SELECT {_columns(day, 'string')} FROM {{orders}}", orders=orders)
    return df.withColumnsRenamed({"price_per_unit": "Price Per Unit", "discount_applied": "Discount Applied"})


SALES = f"WITH sales AS (SELECT {_columns(chr(39).join(['strftime(o_orderdate, ', '%Y-%m-%d', ')']), 'varchar')} FROM orders)"
PRICED = SALES + """, priced AS (
  SELECT * REPLACE (coalesce(price_per_unit, round(total_spent / quantity / 0.5) * 0.5) AS price_per_unit) FROM sales)"""
ITEMISED = PRICED + """, rules AS (
  SELECT category, price_per_unit, min(item) AS rule FROM priced
  WHERE category IS NOT NULL AND price_per_unit IS NOT NULL AND item IS NOT NULL
  GROUP BY ALL HAVING count(DISTINCT item) = 1),
itemised AS (
  SELECT priced.* REPLACE (coalesce(item, rule) AS item)
  FROM priced LEFT JOIN rules ON priced.category = rules.category AND priced.price_per_unit = rules.price_per_unit)"""
COUNTED = ITEMISED + """, n1 AS (
  SELECT item, quantity AS q, row_number() OVER (PARTITION BY item ORDER BY count(*) DESC, quantity) AS r
  FROM itemised WHERE quantity IS NOT NULL GROUP BY item, quantity),
n2 AS (
  SELECT category, quantity AS q, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, quantity) AS r
  FROM itemised WHERE quantity IS NOT NULL GROUP BY category, quantity),
counted AS (
  SELECT itemised.* REPLACE (coalesce(quantity, n1.q, n2.q) AS quantity) FROM itemised
  LEFT JOIN n1 ON itemised.item = n1.item AND n1.r = 1
  LEFT JOIN n2 ON itemised.category = n2.category AND n2.r = 1),
full_sales AS (SELECT * REPLACE (coalesce(total_spent, price_per_unit * quantity) AS total_spent) FROM counted)"""


def named(spark, folder) -> DataFrame:
    return sales(spark, folder).withColumnsRenamed(
        {"Price Per Unit": "price_per_unit", "Discount Applied": "discount_applied"}
    )


@query("b_i4_arithmetic_reconstruct", PRICED + "SELECT k, price_per_unit, quantity, coalesce(total_spent, price_per_unit * quantity) AS total_spent FROM priced")
def _(spark, folder):
    df = named(spark, folder).select("k", "price_per_unit", "quantity", "total_spent")
    priced = impute.reconstruct_price(df, "price_per_unit", "total_spent", "quantity")
    return impute.reconstruct_total(priced, "total_spent", "price_per_unit", "quantity")


@query("b_i5_dependency_table", SALES + """
SELECT category, price_per_unit, min(item) AS item, count(DISTINCT item) = 1 AS is_unique, count(*) AS support
FROM sales WHERE category IS NOT NULL AND price_per_unit IS NOT NULL AND item IS NOT NULL GROUP BY ALL""")
def _(spark, folder):
    return impute.dependency_table(named(spark, folder), ["category", "price_per_unit"], "item")


@query("b_i5_infer_item", ITEMISED + "SELECT k, category, price_per_unit, item FROM itemised")
def _(spark, folder):
    priced = impute.reconstruct_price(named(spark, folder), "price_per_unit", "total_spent", "quantity")
    filled = impute.infer_by_dependency(priced, ["category", "price_per_unit"], "item")
    return filled.select("k", "category", "price_per_unit", "item")


# Columns of the sales in which dependencies and identifying sets are looked for.
_SET_COLUMNS = ["category", "item", "price_per_unit", "customer", "payment_method", "location"]


def _column_sets(least: int, most: int) -> list[tuple[str, ...]]:
    return [c for size in range(least, most + 1) for c in itertools.combinations(_SET_COLUMNS, size)]


def _set_name(columns) -> str:
    return ",".join(columns)


def _distinct_sql(columns) -> str:
    return f"SELECT '{_set_name(columns)}' AS name, (SELECT count(*) FROM (SELECT DISTINCT {_set_name(columns) or '1'} FROM priced)) AS n"


def _pairs_sql(most: int) -> str:
    rows = []
    for given in _column_sets(0, most):
        for a in _SET_COLUMNS:
            if a not in given:
                both = [c for c in _SET_COLUMNS if c in given or c == a]
                rows.append(f"('{_set_name(given)}', '{a}', '{_set_name(both)}')")
    return ", ".join(rows)


@query("b_i5_minimal_dependencies", PRICED + f""", counted AS ({' UNION ALL '.join(map(_distinct_sql, _column_sets(0, 4)))}),
pairs(given, inferred, united) AS (VALUES {_pairs_sql(3)}),
held AS (SELECT p.*, x.n FROM pairs p JOIN counted x ON x.name = p.given JOIN counted y ON y.name = p.united WHERE x.n = y.n)
SELECT given, inferred, n = (SELECT count(*) FROM priced) AS is_key FROM held h WHERE NOT EXISTS (
  SELECT 1 FROM held s WHERE s.inferred = h.inferred AND s.given <> h.given
    AND len(list_filter(string_split(s.given, ','), lambda c: c <> '' AND NOT list_contains(string_split(h.given, ','), c))) = 0)""")
def _(spark, folder):
    priced = impute.reconstruct_price(named(spark, folder), "price_per_unit", "total_spent", "quantity")
    found = column_sets.minimal_dependencies(priced, _SET_COLUMNS, max_given=3)
    return found.withColumn("given", F.array_join("given", ","))


def _risk_sql(columns) -> str:
    names = _set_name(columns)
    return f"""SELECT '{names}' AS columns, min(n) AS smallest_group, count(*) FILTER (n < 20) AS small_groups,
    coalesce(sum(n) FILTER (n < 20), 0)::bigint AS rows_at_risk FROM (SELECT count(*) AS n FROM sales GROUP BY {names})"""


@query("c_b6_smallest_identifying_sets", SALES + f""", tried AS ({' UNION ALL '.join(map(_risk_sql, _column_sets(1, 6)))}),
risky AS (SELECT * FROM tried WHERE smallest_group < 20)
SELECT * FROM risky r WHERE NOT EXISTS (SELECT 1 FROM risky s WHERE s.columns <> r.columns
  AND len(list_filter(string_split(s.columns, ','), lambda c: NOT list_contains(string_split(r.columns, ','), c))) = 0)""")
def _(spark, folder):
    found = column_sets.smallest_identifying_sets(named(spark, folder), _SET_COLUMNS, k=20)
    return found.withColumn("columns", F.array_join("columns", ","))


@query("b_i6_mode_hierarchy", """WITH part_gaps AS (
  SELECT p_partkey, p_brand, p_type, CASE WHEN p_partkey % 5 > 0 AND p_brand <> 'Brand#2' THEN p_size END AS p_size FROM part),
n1 AS (SELECT p_brand, p_type, p_size AS q, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY count(*) DESC, p_size) AS r
  FROM part_gaps WHERE p_size IS NOT NULL GROUP BY p_brand, p_type, p_size),
n2 AS (SELECT p_type, p_size AS q, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_size) AS r
  FROM part_gaps WHERE p_size IS NOT NULL GROUP BY p_type, p_size),
n3 AS (SELECT p_size AS q FROM part_gaps WHERE p_size IS NOT NULL GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1)
SELECT p_partkey, g.p_brand, g.p_type, coalesce(p_size, n1.q, n2.q, (SELECT q FROM n3)) AS p_size FROM part_gaps g
LEFT JOIN n1 ON g.p_brand = n1.p_brand AND g.p_type = n1.p_type AND n1.r = 1
LEFT JOIN n2 ON g.p_type = n2.p_type AND n2.r = 1""")
def _(spark, folder):
    known = (F.col("p_partkey") % 5 > 0) & (F.col("p_brand") != "Brand#2")
    df = table(spark, folder, "part").select(
        "p_partkey", "p_brand", "p_type", F.when(known, F.col("p_size")).alias("p_size")
    )
    return impute.fill_mode_hierarchy(df, "p_size", [["p_brand", "p_type"], ["p_type"], []])


@query("b_i6_quantity_by_item", COUNTED + "SELECT k, item, quantity FROM full_sales")
def _(spark, folder):
    return plan.clean(sales(spark, folder)).select("k", "item", "quantity")


_GAPS = ["item", "price_per_unit", "quantity", "total_spent"]


@query("b_i7_structured_missingness", SALES + f""", s AS (SELECT concat_ws(',', {', '.join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _GAPS)}) AS missing_together FROM sales)
SELECT missing_together, count(*) AS row_count FROM s WHERE contains(missing_together, ',') GROUP BY ALL""")
def _(spark, folder):
    return structured_missingness(named(spark, folder), _GAPS)


@query("b_t12_discount_flag", SALES + """
SELECT CASE discount_applied WHEN 'True' THEN true WHEN 'False' THEN false END AS discount_applied, count(*) AS row_count
FROM sales GROUP BY ALL""")
def _(spark, folder):
    flag = to_boolean(F.col("discount_applied")).alias("discount_applied")
    return named(spark, folder).select(flag).groupBy("discount_applied").agg(F.count("*").alias("row_count"))


@query("b_n7_retail_clean", COUNTED + """
SELECT k, category, item, price_per_unit, quantity, total_spent, transaction_date,
  CASE discount_applied WHEN 'True' THEN true WHEN 'False' THEN false END AS discount_applied,
  customer, payment_method, location, transaction_date AS transaction_date_iso,
  year(CAST(transaction_date AS date))::int AS transaction_year, month(CAST(transaction_date AS date))::int AS transaction_month
FROM full_sales""")
def _(spark, folder):
    return plan.clean(sales(spark, folder))


def _dim_sql(column: str) -> str:
    return f"""d_{column} AS (SELECT {column}, '{column}_' || row_number() OVER (ORDER BY {column}) AS {column}_id
  FROM (SELECT DISTINCT {column} FROM full_sales WHERE {column} IS NOT NULL))"""


_DIMS = list(plan.DIMENSIONS)


@query("b_n7_retail_star", COUNTED + ", " + ", ".join(_dim_sql(c) for c in _DIMS) + f"""
SELECT row_number() OVER (ORDER BY k) AS row_id, k, {', '.join(f'{c}_id' for c in _DIMS)}, price_per_unit, quantity, total_spent
FROM full_sales {' '.join(f'LEFT JOIN d_{c} ON full_sales.{c} = d_{c}.{c}' for c in _DIMS)}""")
def _(spark, folder):
    fact = plan.star(plan.clean(sales(spark, folder)), ["k"])["fact_sales"]
    return fact.select("row_id", "k", *plan.DIMENSIONS.values(), "price_per_unit", "quantity", "total_spent")


@query("b_n7_retail_dimensions", COUNTED + ", " + ", ".join(_dim_sql(c) for c in _DIMS) + " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, {c}_id AS id, {c} AS name FROM d_{c}" for c in _DIMS))
def _(spark, folder):
    tables = plan.star(plan.clean(sales(spark, folder)), ["k"])
    parts = [
        tables[f"dim_{c}"].select(F.lit(c).alias("dimension"), F.col(i).alias("id"), F.col(c).alias("name"))
        for c, i in plan.DIMENSIONS.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


@query("b_s7_retail_audit", COUNTED + " SELECT column_name, filled_values, missing_values FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT count(*) - count({c}) FROM sales) - (count(*) - count({c})) AS filled_values, count(*) - count({c}) AS missing_values FROM full_sales"
    for c in plan.FILLED) + ")")
def _(spark, folder):
    wide = sales(spark, folder)
    path = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    write_document(plan.audit_document(wide, plan.clean(wide)), path)
    # Read back as the document it is.
    schema = "rows long, filled_values map<string,long>, missing_values map<string,long>"
    document = spark.read.schema(schema).json(path)
    filled = document.select(F.explode("filled_values").alias("column_name", "filled_values"), "missing_values")
    missing = F.try_element_at("missing_values", F.col("column_name"))
    return filled.select("column_name", "filled_values", missing.alias("missing_values"))


# --- calorie efficiency ------------------------------------------------------------

_LABEL = "CASE WHEN event_id % 16 = 0 THEN 'High Efficiency' WHEN event_id % 16 = 1 THEN ' Moderate ' ELSE 'Low Efficiency' END"
_CALORIE = f"""event_id, CAST(event_id % 60 + 18 AS int) AS age,
  CAST(event_id % 40 AS double) / 128 AS body_fat_percentage, CAST(event_id % 25 AS double) / 64 AS muscle_mass_ratio,
  CAST(user_id AS double) + CAST(event_id % 4 AS double) / 4 AS heart_rate,
  CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 90 AS double) / 10 + 1 ELSE CAST(event_id % 100 AS double) / 100 END AS efficiency_score,
  {_LABEL} AS calorie_efficiency, CAST(1500 AS int) AS calories_burned"""
CALORIE = f"""WITH wide AS (SELECT {_CALORIE} FROM events), cleaned AS (
  SELECT event_id, age, body_fat_percentage * 100 AS body_fat_pct, muscle_mass_ratio * 100 AS muscle_mass_pct,
    CAST(round(heart_rate) AS int) AS heart_rate,
    CASE WHEN efficiency_score > 1 THEN efficiency_score / 10 ELSE efficiency_score END AS efficiency_score,
    CASE lower(trim(calorie_efficiency)) WHEN 'low efficiency' THEN 'low' WHEN 'moderate' THEN 'moderate' WHEN 'high efficiency' THEN 'high' END AS calorie_efficiency,
    calories_burned, efficiency_score > 1 AS rescaled FROM wide)"""


def fitness(spark, folder) -> DataFrame:
    return spark.sql(f"SELECT {_CALORIE} FROM {{events}}", events=table(spark, folder, "events"))


@query("b_n8_calorie_clean", CALORIE + "SELECT * EXCLUDE (rescaled) FROM cleaned")
def _(spark, folder):
    return calorie.clean(fitness(spark, folder), ["heart_rate"])


@query("b_t9_rescaled_count", CALORIE + "SELECT count(*) FILTER (rescaled) AS rescaled_rows, count(*) AS row_count FROM cleaned")
def _(spark, folder):
    wide = fitness(spark, folder)
    return wide.agg(F.count_if(calorie.rescaled(wide)).alias("rescaled_rows"), F.count("*").alias("row_count"))


_GROUPS = {
    "demographics": ["age", "body_fat_pct", "muscle_mass_pct"],
    "activity": ["heart_rate", "calories_burned"],
    "outcomes": ["efficiency_score", "calorie_efficiency"],
}


@query("b_n8_vertical_split", CALORIE + """, keyed AS (SELECT row_number() OVER (ORDER BY event_id) AS record_id, * FROM cleaned)
SELECT a.record_id, a.age, a.body_fat_pct, a.muscle_mass_pct, a.heart_rate, a.efficiency_score, a.calorie_efficiency FROM keyed a""")
def _(spark, folder):
    cleaned = calorie.clean(fitness(spark, folder), ["heart_rate"])
    tables, _ = calorie.split(cleaned, ["event_id"], _GROUPS)
    # Put together again by their shared key: nothing may be lost or doubled.
    return tables["demographics"].join(tables["activity"], "record_id").join(tables["outcomes"], "record_id")


@query("b_s7_calorie_audit", CALORIE + """
SELECT count(*) AS rows, count(*) FILTER (rescaled) AS rescaled_rows, 0::bigint AS unmapped_label_rows, '1500' AS calories_burned,
  'body_fat_pct' AS body_fat_percentage FROM cleaned""")
def _(spark, folder):
    wide = fitness(spark, folder)
    cleaned = calorie.clean(wide, ["heart_rate"])
    _, constants = calorie.split(cleaned, ["event_id"], _GROUPS)
    path = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    write_document(calorie.audit_document(wide, constants), path)
    schema = "rows long, rescaled_rows long, unmapped_label_rows long, renamed map<string,string>, dropped_constants map<string,string>"
    document = spark.read.schema(schema).json(path)
    return document.select(
        "rows", "rescaled_rows", "unmapped_label_rows",
        F.col("dropped_constants")["calories_burned"].alias("calories_burned"),
        F.col("renamed")["body_fat_percentage"].alias("body_fat_percentage"),
    )
