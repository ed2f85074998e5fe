"""Values that are given by the data and its rules, not by this library."""

from __future__ import annotations

# Text written for a missing value in text outputs.
NULL_TOKEN = "NULL"

# Characters removed at both ends of a text before it is read.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Arabic-Indic and Persian digits, and the digits they stand for.
LOCAL_DIGITS = (
    "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669"
    "\u06f0\u06f1\u06f2\u06f3\u06f4\u06f5\u06f6\u06f7\u06f8\u06f9"
)
ASCII_DIGITS = "01234567890123456789"

# Cell texts that a default CSV reader takes as missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Amounts written as words.
NUMBER_WORDS = {"one hundred": "100"}

# Raw spelling (lower case) -> canonical status.
STATUS_MAP = {
    "success": "success",
    "succeed": "success",
    "fail": "failed",
    "failed": "failed",
}

# Raw spelling (lower case) -> canonical card brand.
CARD_MAP = {
    "visa": "Visa",
    "vsa": "Visa",
    "mastercard": "MasterCard",
    "master card": "MasterCard",
    "master-card": "MasterCard",
    "mastcard": "MasterCard",
    "amex": "Amex",
    "discover": "Discover",
}

# Raw spelling (lower case) -> canonical city.
CITY_MAP = {
    "tehran": "Tehran",
    "thr": "Tehran",
    "thran": "Tehran",
    "tehr@n": "Tehran",
    "tabriz": "Tabriz",
    "isfahan": "Isfahan",
    "mashhad": "Mashhad",
    "shiraz": "Shiraz",
    "qom": "Qom",
    "karaj": "Karaj",
    "ahvaz": "Ahvaz",
}

# Efficiency label (lower case) -> canonical label.
EFFICIENCY_MAP = {
    "low efficiency": "low",
    "moderate": "moderate",
    "high efficiency": "high",
}

# Month spelling (lower case) -> canonical month name.
MONTH_MAP = {
    "january": "January",
    "jan": "January",
    "february": "February",
    "feb": "February",
    "march": "March",
    "mar": "March",
    "april": "April",
    "apr": "April",
    "may": "May",
    "june": "June",
    "jun": "June",
    "july": "July",
    "jul": "July",
    "august": "August",
    "aug": "August",
    "september": "September",
    "sep": "September",
    "sept": "September",
    "october": "October",
    "oct": "October",
    "november": "November",
    "nov": "November",
    "december": "December",
    "dec": "December",
}

# Texts that mean true and false.
TRUE_TEXTS = ("true", "t", "yes", "y", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "0")

# Names of the time layouts and the pattern of each; first match wins.
TIME_LAYOUTS = (
    ("HH:MM YYYY-MM-DD", r"^\d{1,2}:\d{2}\s+\d{4}-\d{2}-\d{2}$"),
    ("HH:MM:SS YYYY-MM-DD", r"^\d{1,2}:\d{2}:\d{2}\s+\d{4}-\d{2}-\d{2}$"),
    ("YYYY-MM-DD HH:MM", r"^\d{4}-\d{2}-\d{2}\s+\d{1,2}:\d{2}$"),
    ("YYYY-MM-DD HH:MM:SS", r"^\d{4}-\d{2}-\d{2}\s+\d{1,2}:\d{2}:\d{2}$"),
    ("YYYY/MM/DD HH:MM", r"^\d{4}/\d{2}/\d{2}\s+\d{1,2}:\d{2}$"),
    ("YYYY/MM/DD HH:MM:SS", r"^\d{4}/\d{2}/\d{2}\s+\d{1,2}:\d{2}:\d{2}$"),
    ("YYYY-MM-DD only", r"^\d{4}-\d{2}-\d{2}$"),
    ("YYYY/MM/DD only", r"^\d{4}/\d{2}/\d{2}$"),
    ("HH:MM only", r"^\d{1,2}:\d{2}$"),
    ("HH:MM:SS only", r"^\d{1,2}:\d{2}:\d{2}$"),
    ("NULL YYYY-MM-DD", r"^NULL\s+\d{4}-\d{2}-\d{2}$"),
    ("HH:MM NULL", r"^\d{1,2}:\d{2}\s+NULL$"),
)
DATE_LAYOUTS = (("YYYY-MM-DD", r"^\d{4}-\d{2}-\d{2}$"),)
CLOCK_LAYOUTS = (("HH:MM:SS", r"^\d{2}:\d{2}:\d{2}$"),)
AMOUNT_LAYOUTS = (
    ("integer", r"^-?\d+$"),
    ("decimal", r"^-?\d+\.\d+$"),
    ("comma-number", r"^-?\d{1,3}(,\d{3})+(\.\d+)?$"),
)

# Columns that a transaction file must have.
EXPECTED_COLUMNS = ("status", "time", "card_type", "city", "amount", "id")

# Pieces of a time text that are looked for one by one (slashes are dashes by then).
DATE_FRAGMENT = r"(?U)\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"
CLOCK_FRAGMENT = r"(?U)\b[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\b"

# Row labels of the reports, by what they count.
DUPLICATE_ID_LABELS = {
    "rows": "Total rows",
    "null": "Rows with null/blank ID",
    "ids": "Rows with non-null ID",
    "repeated": "Rows with duplicated ID",
    "rate": "Duplicate ID rate (%) over non-null IDs",
}
DUPLICATE_ROW_LABELS = {
    "rows": "Total rows",
    "members": "Rows that are part of exact duplicate groups",
    "groups": "Unique exact duplicate row patterns",
}
AMOUNT_LABELS = {
    "text": "Non-numeric amount rows",
    "negative": "Negative amounts (converted to positive)",
}
ISSUE_LABELS = [
    ("status", "invalid status values", "status_invalid_flag"),
    ("time", "invalid datetime values", "time_invalid_flag"),
    ("card_type", "invalid card_type values", "card_type_invalid_flag"),
    ("city", "invalid city values", "city_invalid_flag"),
    ("amount", "non-numeric values", "amount_non_numeric_flag"),
    ("amount", "negative values", "amount_negative_flag"),
    ("amount", "IQR outlier values", "amount_outlier_flag"),
]
DUPLICATED_ID_ISSUE = "duplicated original id rows"
