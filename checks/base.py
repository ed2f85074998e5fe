"""Query registry, the derived dirty tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_YEAR = 2026

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(number: str, *values: str) -> str:
    """SQL: value by remainder, the same text in both engines."""
    cases = " ".join(f"WHEN {number} % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {cases} END"


STATUSES = ("success", " Success ", "succeed", "fail", "failed", "FAIL")
CARDS = (
    "Visa", "visa", "VISA", "Vsa", "MasterCard",
    "Master Card", "Master-Card", "MastCard", "Amex", "Discover",
)
CITIES = (
    "Tehran", "TEHRAN", "THR", "ThRan", "tehr@n", "Karaj", "karaj",
    "Tabriz", "Isfahan", "Mashhad", "Shiraz", "Qom", "Ahvaz",
)

# The parts of the dirty transactions that read the same in Spark SQL and DuckDB.
_STATUS = f"""CASE WHEN k % 211 = 0 THEN NULL WHEN k % 197 = 0 THEN '' WHEN k % 193 = 0 THEN 'pending'
    ELSE {pick('k', *STATUSES)} END"""
_CARD = f"CASE WHEN k % 31 = 0 THEN NULL ELSE {pick('k', *CARDS)} END"
_CITY = f"CASE WHEN k % 89 = 0 THEN NULL ELSE {pick('k', *CITIES)} END"


def _time(iso: str, swapped: str) -> str:
    return f"""CASE WHEN k % 997 = 0 THEN NULL
    WHEN k % 499 = 1 THEN '99:99 2025-13-40' WHEN k % 499 = 2 THEN '25:61 2001-09-11'
    WHEN k % 499 = 3 THEN '3pm 2001/09/11' WHEN k % 499 = 4 THEN '03-00-2001 09-11'
    WHEN k % 499 = 5 THEN '12:00' WHEN k % 499 = 6 THEN '2001-02-29 10:00:00'
    WHEN k % 499 = 7 THEN '2099-01-01 00:00:00' WHEN k % 100 = 8 THEN {swapped} ELSE {iso} END"""


def _amount(text: str) -> str:
    decimal = f"CAST(CAST(price AS decimal(18,2)) AS {text})"
    return f"""CASE WHEN k % 1009 = 0 THEN NULL WHEN k % 5003 = 1 THEN 'one hundred'
    WHEN k % 33 = 0 THEN '9999999999' WHEN k % 8 = 0 THEN concat('-', {decimal})
    WHEN k % 3 = 1 THEN CAST(CAST(floor(price) AS bigint) AS {text}) ELSE {decimal} END"""


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty transactions derived from all orders; ``k`` is unique and gives the row order."""
    return dirty_from(table(spark, folder, "orders"))


def dirty_from(orders: DataFrame) -> DataFrame:
    """The same from a table or a stream of orders."""
    orders = orders.selectExpr(
        "o_orderkey AS k",
        "o_totalprice AS price",
        "o_orderdate + make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 86400) AS t",
    )
    iso, swapped = "date_format(t, 'yyyy-MM-dd HH:mm:ss')", "date_format(t, 'HH:mm yyyy-MM-dd')"
    return orders.selectExpr(
        "k",
        "CAST(k % 99 + 1 AS string) AS id",
        f"{_STATUS} AS status",
        f"{_time(iso, swapped)} AS time",
        f"{_CARD} AS card_type",
        f"{_CITY} AS city",
        f"{_amount('string')} AS amount",
    )


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables as a file stream."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


RAW_COLUMNS = ["id", "status", "time", "card_type", "city", "amount"]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """The six raw columns alone."""
    return dirty(spark, folder).select(*RAW_COLUMNS)


_ISO_SQL, _SWAPPED_SQL = "strftime(t, '%Y-%m-%d %H:%M:%S')", "strftime(t, '%H:%M %Y-%m-%d')"
DIRTY = f"""WITH base AS (
  SELECT o_orderkey AS k, o_totalprice AS price,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS t FROM orders),
dirty AS (
  SELECT k, CAST(k % 99 + 1 AS varchar) AS id, {_STATUS} AS status,
  {_time(_ISO_SQL, _SWAPPED_SQL)} AS time, {_CARD} AS card_type, {_CITY} AS city,
  {_amount('varchar')} AS amount FROM base)
"""

_FORMATS = """['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%H:%M:%S %Y-%m-%d', '%H:%M %Y-%m-%d',
  '%Y-%m-%d', '%Y/%m/%d %H:%M:%S', '%Y/%m/%d %H:%M', '%Y/%m/%d', '%H-%M-%Y %m-%d', '%I%p %Y/%m/%d']"""


def parse_sql(text: str) -> str:
    parsed = f"try_strptime({text}, {_FORMATS})"
    return f"CASE WHEN year({parsed}) BETWEEN 1678 AND {MAX_YEAR} THEN {parsed} END"


def number_sql(text: str, words: bool = True) -> str:
    t = f"trim({text})"
    if words:
        t = f"CASE WHEN lower(trim({text})) = 'one hundred' THEN '100' ELSE trim({text}) END"
    pattern = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    return f"CASE WHEN regexp_full_match({t}, '{pattern}') THEN TRY_CAST({t} AS double) END"


DAY_SQL = rf"""list_filter(regexp_extract_all(time, '\b\d{{4}}[-/]\d{{2}}[-/]\d{{2}}\b'),
  lambda x: TRY_CAST(replace(x, '/', '-') AS date) IS NOT NULL
            AND year(TRY_CAST(replace(x, '/', '-') AS date)) <= {MAX_YEAR})[1]"""
CLOCK_SQL = r"""list_filter(regexp_extract_all(time, '\b\d{1,2}:\d{2}(?::\d{2})?\b'),
  lambda x: TRY_CAST(split_part(x, ':', 1) AS int) <= 23 AND TRY_CAST(split_part(x, ':', 2) AS int) <= 59)[1]"""

# Adds: number (of the raw amount), day, clock, parsed; then the cleansed table.
CLEAN = DIRTY + f""", stripped AS (
  SELECT k, id, trim(status) AS status, trim(time) AS time, trim(card_type) AS card_type,
         trim(city) AS city, trim(amount) AS amount FROM dirty),
parts AS (
  SELECT *, {number_sql('amount')} AS number, {parse_sql('time')} AS parsed,
         replace({DAY_SQL}, '/', '-') AS day, left({CLOCK_SQL}, 5) AS clock FROM stripped),
bounds1 AS (
  SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
    SELECT quantile_cont(abs(number), 0.25) AS q1, quantile_cont(abs(number), 0.75) AS q3
    FROM parts WHERE abs(number) > 0)),
salvaged AS (
  SELECT *, CASE WHEN parsed IS NOT NULL THEN time
      WHEN day IS NOT NULL AND clock IS NOT NULL THEN clock || ' ' || day
      WHEN day IS NOT NULL THEN 'NULL ' || day WHEN clock IS NOT NULL THEN clock || ' NULL'
      ELSE 'NULL' END AS time_text,
    coalesce(abs(number) < lower OR abs(number) > upper, false) AS amount_nulled
  FROM parts, bounds1),
clean AS (
  SELECT k, id, status, time_text AS time, card_type, city,
    CASE WHEN NOT amount_nulled THEN amount END AS amount,
    time_text <> coalesce(time, '') AS time_formatted, amount_nulled FROM salvaged)
"""

STATUS_SQL = """CASE lower(trim(status)) WHEN 'success' THEN 'success' WHEN 'succeed' THEN 'success'
  WHEN 'fail' THEN 'failed' WHEN 'failed' THEN 'failed' END"""
CARD_SQL = """CASE WHEN lower(trim(card_type)) IN ('visa', 'vsa') THEN 'Visa'
  WHEN lower(trim(card_type)) IN ('mastercard', 'master card', 'master-card', 'mastcard') THEN 'MasterCard'
  WHEN lower(trim(card_type)) = 'amex' THEN 'Amex' WHEN lower(trim(card_type)) = 'discover' THEN 'Discover' END"""
CITY_SQL = """CASE WHEN lower(trim(city)) IN ('tehran', 'thr', 'thran', 'tehr@n') THEN 'Tehran'
  WHEN lower(trim(city)) IN ('tabriz', 'isfahan', 'mashhad', 'shiraz', 'qom', 'karaj', 'ahvaz')
  THEN upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) END"""

# The transformed table; its outlier bounds are taken again on the cleansed amounts.
DONE = CLEAN + f""", numbered AS (
  SELECT *, {number_sql('amount')} AS number, {parse_sql('time')} AS parsed FROM clean),
bounds2 AS (
  SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
    SELECT quantile_cont(abs(number), 0.25) AS q1, quantile_cont(abs(number), 0.75) AS q3
    FROM numbered WHERE abs(number) > 0)),
coded AS (
  SELECT *, {STATUS_SQL} AS status_clean, {CARD_SQL} AS card_type_clean, {CITY_SQL} AS city_clean,
    coalesce(abs(number) < lower OR abs(number) > upper, false) AS amount_outlier_flag
  FROM numbered, bounds2),
done AS (
  SELECT *, status_clean IS NULL AND coalesce(status, '') <> '' AS status_invalid_flag,
    card_type_clean IS NULL AND coalesce(card_type, '') <> '' AS card_type_invalid_flag,
    city_clean IS NULL AND coalesce(city, '') <> '' AS city_invalid_flag,
    parsed IS NOT NULL AS time_valid_flag,
    parsed IS NULL AND coalesce(time, '') <> '' AS time_invalid_flag,
    number IS NULL AND coalesce(amount, '') <> '' AS amount_non_numeric_flag,
    coalesce(number < 0, false) AS amount_negative_flag, abs(number) AS amount_numeric,
    CASE WHEN NOT amount_outlier_flag THEN abs(number) END AS amount_clean,
    strftime(parsed, '%Y-%m-%d %H:%M:%S') AS time_clean, strftime(parsed, '%Y-%m-%d') AS date_clean,
    strftime(parsed, '%H:%M:%S') AS clock_time_clean,
    printf('TRX_%05d', row_number() OVER (ORDER BY k)) AS transaction_id FROM coded)
"""


def unpivot_counts(source: str, rows: list[tuple[str, ...]], names: tuple[str, ...]) -> str:
    """SQL: one SELECT per report row, stacked."""
    return " UNION ALL ".join(
        "SELECT " + ", ".join(f"{e} AS {n}" for e, n in zip(row, names)) + f" FROM {source}"
        for row in rows
    )
