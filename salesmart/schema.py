"""Layout of the sales data and the business rules' parameters.

The values under "fixed values" define the data contract and must stay as they are for
results to agree with the original retail pipeline.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------

# raw CSV columns, in file order; every one is read as nullable STRING
RAW_COLUMNS = (
    "order_id", "customer_id", "product_id", "product_name", "category", "sub_category",
    "region", "country", "order_date", "ship_date", "quantity", "unit_price", "discount",
    "sales_amount", "profit", "shipping_cost", "payment_method", "status",
)
# rows missing any of these (after trimming) are quarantined
REQUIRED_FIELDS = ("order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price")
# natural key of a sales line; the latest version by order_date is kept
DEDUP_KEY = ("order_id", "product_id")
# accepted date layouts, tried in this order; the first that parses wins
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")
DATE_COLUMNS = ("order_date", "ship_date")
# money columns; discount is a fraction
MONEY_COLUMNS = ("unit_price", "sales_amount", "profit", "shipping_cost")
# sales_amount deviating from quantity*unit_price*(1-discount) by more than this fraction is flagged
MISMATCH_TOLERANCE = "0.01"
FLAG_MISMATCH, FLAG_OK = "MISMATCH", "OK"
# quality tags; the first two are the quarantine reasons of the original pipeline
QUALITY_OK = "ok"
MISSING_REQUIRED = "missing_required_field"
INVALID_NUMERIC = "invalid_numeric"
UNPARSEABLE_NUMERIC = "unparseable_numeric"   # ours: rows the original lost silently
UNREPRESENTABLE_AMOUNT = "unrepresentable_amount"   # ours: an amount of more digits than the stored types hold
MALFORMED = "malformed_record"   # ours: a line of too few or too many fields (an open quote swallows the fields after it)
# customer value segments (lifetime value >= threshold) and recency status (days <= limit)
HIGH_VALUE_MIN, MID_VALUE_MIN = 5000, 1000
SEGMENT_HIGH, SEGMENT_MID, SEGMENT_LOW = "HIGH_VALUE", "MID_VALUE", "LOW_VALUE"
ACTIVE_MAX_DAYS, AT_RISK_MAX_DAYS = 90, 365
STATUS_ACTIVE, STATUS_AT_RISK, STATUS_CHURNED = "ACTIVE", "AT_RISK", "CHURNED"
# top products per region
TOP_N = 10
# KPI tables are small: at most this many files per output partition
KPI_MAX_FILES = 5
# tasks that write a table of (year, month) folders, where the cluster has as many cores (ours)
KPI_WRITERS = 64
# rows that a task writes of the cleaned table where months are written as they were staged (ours)
FILE_ROWS = 1_000_000
# repeated keys that every task may know (ours: 8 bytes each, and the numbers of their kept rows)
REPEATED_KEYS = 1_000_000
# audit columns added to written tables and dropped again by the report
AUDIT_COLUMNS = ("etl_job", "etl_ts", "etl_processed_at")
# report key used where the original would have produced a NULL map key
UNKNOWN_KEY = "UNKNOWN"

# ---------------------------------------------------------------------------
# types (ours): exact decimals for money so that sums never depend on partitioning
# ---------------------------------------------------------------------------

# six decimals are kept; amounts from 1e18 on are tagged, never turned into NULL
MONEY = T.DecimalType(24, 6)        # parsed money and discount text
TOTAL = T.DecimalType(38, 2)        # rounded money totals stored in KPI tables

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# ours: a malformed line's text and every line's file, where the scan was asked for them
MALFORMED_COLUMN, FILE_COLUMN = "malformed_record", "source_file"
QUARANTINE_COLUMNS = ("order_id", "quarantine_reason", "quarantine_ts")
