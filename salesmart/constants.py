"""Fixed values the mart must reproduce exactly.

Everything in this module is a value, not logic: placeholder lists, issue
vocabulary, notes, unknown members, date range and widths.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Placeholders that mean "missing" after stripping, per column.
# ---------------------------------------------------------------------------
TXN_MISSING_LOWER = ("nan", "none")                      # compared lower-cased
CUSTOMER_PLACEHOLDERS = ("", "None", "nan")
PRODUCT_ID_PLACEHOLDERS = ("", "None", "nan")
PRODUCT_NAME_PLACEHOLDERS = ("", "None", "nan")
CATEGORY_PLACEHOLDERS = ("", "None", "nan", "NaN")
REGION_PLACEHOLDERS = ("", "None", "nan", "NaN")
UNKNOWN = "Unknown"

# Characters removed by "strip" (Python's ASCII whitespace set).
STRIP_CHARS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# ---------------------------------------------------------------------------
# Bad-data log vocabulary (source, column, issue, note).
# ---------------------------------------------------------------------------
SOURCE_SALES = "python_etl"
SOURCE_CUSTOMERS = "ssis_pkg"

ISSUES = {
    "duplicate_full_row": ("ALL_COLUMNS", "duplicate_full_row", "Dropped this full duplicate row"),
    "txn_missing": ("transaction_id", "missing_or_blank", "Dropped row due to missing or blank transaction_id"),
    "txn_product_dup": ("transaction_id", "duplicate_transactionid+productid", "Dropped duplicate transactionid+productid pairs"),
    "customer_missing": ("customer_id", "missing", 'customer_id missing or blank; replaced with "Unknown"'),
    "product_id_missing": ("product_id", "missing", "product_id missing or blank; replaced with 'Unknown'"),
    "product_name_missing": ("product_name", "missing", "product_name missing or blank; replaced with 'Unknown'"),
    "category_missing": ("category", "missing", "category missing or blank; replaced with 'Unknown'"),
    "price_invalid": ("price", "invalid_value", "price missing, non-numeric, or negative; replaced with 0"),
    "quantity_invalid": ("quantity", "invalid_value", "quantity missing, non-numeric, or negative; replaced with 0"),
    "discount_invalid": ("discount", "invalid_value", "discount missing, non-numeric, or negative; replaced with 0"),
    "date_missing": ("date", "missing_value", "date missing or blank; replaced with 1990-01-01"),
    "date_invalid": ("date", "invalid_format", "invalid date format; replaced with 19900101"),
    "region_missing": ("region", "missing", "region missing or blank; replaced with 'Unknown'"),
    "fact_key_dup": ("composite_key", "duplicate_key", "Duplicate (transaction_id, product_id) combination found; dropped"),
    "customer_unmatched": ("customer_id", "unknown_reference", "customer_id not in DimCustomer; replaced with 'Unknown'"),
    "date_unmatched": ("date", "unknown_reference", "date not in DimDate; replaced with 19900101"),
    "customer_blank_id": ("customer_id", "missing_or_blank", "Dropped customer row with blank customer_id"),
    "customer_points_invalid": ("loyalty_points", "invalid_value", "loyalty_points not an integer; replaced with 0"),
    "customer_join_date_invalid": ("join_date", "invalid_format", "join_date not a yyyymmdd integer; replaced with 19900101"),
}

# ---------------------------------------------------------------------------
# Unknown members seeded into the dimensions.
# ---------------------------------------------------------------------------
UNKNOWN_CUSTOMER = ("Unknown", "Unknown Customer", "Unknown", "Unknown", 19900101, 0)
UNKNOWN_PRODUCT = ("Unknown", "Unknown Product", "Unknown", "0.00")
UNKNOWN_DATE = (19900101, _dt.date(1990, 1, 1), 1990, 1, "Unknown", 1, 0)

SENTINEL_DATE = _dt.date(1990, 1, 1)
SENTINEL_DATE_KEY = 19900101

# ---------------------------------------------------------------------------
# Date dimension range and view cut-off.
# ---------------------------------------------------------------------------
DIM_DATE_START = _dt.date(2010, 1, 1)
DIM_DATE_END = _dt.date(2030, 12, 31)
VIEW_DATE_FROM = _dt.date(2010, 1, 1)

# ---------------------------------------------------------------------------
# Column widths of the target tables.
# ---------------------------------------------------------------------------
WIDTHS = {
    "dim_customer": {"customer_id": 50, "customer_name": 255, "email": 320, "region": 50},
    "dim_product": {"product_id": 20, "product_name": 255, "category": 100},
    "dim_date": {"month_name": 20},
    "fact_sales": {"transaction_id": 20, "product_id": 20, "customer_id": 50, "region": 50},
    "bad_data_log": {"source_system": 50, "record_id": 100, "bad_column": 100, "issue_type": 50, "notes": 255},
}

# NOT NULL columns of the target tables (a fact's customer may be null).
NOT_NULL = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id", "product_name", "price"],
    "dim_date": ["date_key", "full_date", "year", "month", "month_name", "day", "quarter"],
    "fact_sales": ["transaction_id", "product_id", "date_key"],
    "bad_data_log": ["log_id", "etl_run_id", "source_system", "bad_column", "issue_type", "original_record"],
}

# Decimal columns of the target tables, (precision, scale).
DECIMALS = {
    "dim_product": {"price": (10, 2)},
    "fact_sales": {"discount": (5, 2)},
}

# Dashboard / query thresholds.
HIGH_VALUE_THRESHOLD = 1000
TOP_N = 5
