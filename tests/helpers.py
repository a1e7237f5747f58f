"""Hand-written raw rows for edge-case tests."""

from __future__ import annotations

from salesmart.schema import RAW_COLUMNS, RAW_SCHEMA

BASE = dict(
    order_id="ORD-1", customer_id="CUST-1", product_id="PROD-1", product_name="Widget",
    category="Cat", sub_category="Sub", region="EU", country="DE", order_date="2024-01-15",
    ship_date="2024-01-17", quantity="2", unit_price="10.00", discount="0.10", sales_amount="18.00",
    profit="3.00", shipping_cost="1.00", payment_method="Card", status="Delivered",
)


def row(**kw) -> tuple:
    d = dict(BASE, **kw)
    return tuple(d[c] for c in RAW_COLUMNS)


def raw_df(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)
