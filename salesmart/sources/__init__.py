"""Readers: raw sales text, the cleaned table, KPI tables and fixture views."""

from salesmart.sources.csv import read_raw_sales, register_raw, schema_drift
from salesmart.sources.fixtures import raw_view, sales_view
from salesmart.sources.parquet import cached, read_cleaned, read_kpi

__all__ = [
    "cached", "raw_view", "read_cleaned", "read_kpi", "read_raw_sales", "register_raw",
    "sales_view", "schema_drift",
]
