"""Stage 3 re-aggregations of the stage-2 KPI tables.

These keep the original's semantics on purpose: a mean of monthly means and a sum of
monthly distinct counts (X1/X2 in ``kpis`` give the exact figures). All inputs are
bounded by dimension sizes (regions x countries x months, segments x statuses, ...).
Stored 2-dp values are cast back to exact DECIMAL before they are summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import exact, mean2, mean_of_means2, ratio_pct, total2
from salesmart.operators.report import RECORD_COUNT_FIELDS


def regional_summary(a1: DataFrame) -> DataFrame:
    """B2: region/country totals over all months (report order: revenue desc)."""
    return a1.groupBy("region", "country").agg(
        total2(exact("total_revenue")).alias("total_revenue"),
        total2(exact("total_profit")).alias("total_profit"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.sum("total_orders").alias("total_orders"),
        mean_of_means2("avg_order_value").alias("avg_order_value"),
        ratio_pct(F.sum(exact("total_profit")), F.sum(exact("total_revenue"))).alias("profit_margin_pct"),
    )


def category_summary(a2: DataFrame) -> DataFrame:
    """category/sub-category totals over all months (report order: category, revenue desc)."""
    return a2.groupBy("category", "sub_category").agg(
        total2(exact("total_revenue")).alias("total_revenue"),
        total2(exact("total_profit")).alias("total_profit"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.sum("total_orders").alias("total_orders"),
        mean_of_means2("avg_discount_pct").alias("avg_discount_pct"),
        ratio_pct(F.sum(exact("total_profit")), F.sum(exact("total_revenue"))).alias("profit_margin_pct"),
    )


def monthly_trends(a3: DataFrame) -> DataFrame:
    """The monthly trend rows with their place in the report: year, month, region."""
    by_place = Window.orderBy(*[F.col(c).asc_nulls_first() for c in ("year", "month", "region")])
    return a3.withColumn("position", F.row_number().over(by_place))      # months x regions: bounded by the calendar


def segment_status_summary(a5: DataFrame) -> DataFrame:
    """Customers per (segment, status) with their lifetime value and order counts."""
    return a5.groupBy("customer_segment", "customer_status").agg(
        F.count(F.lit(1)).alias("customer_count"),
        total2(exact("lifetime_value")).alias("total_lifetime_value"),
        mean2(exact("lifetime_value")).alias("avg_lifetime_value"),
        mean2("total_orders").alias("avg_orders_per_customer"),
    )


def segment_totals(a5: DataFrame) -> DataFrame:
    """Customers per value segment."""
    return a5.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("count"))


def payment_summary(a6: DataFrame) -> DataFrame:
    """Payment method/region totals (report order: region, revenue desc)."""
    return a6.groupBy("payment_method", "region").agg(
        F.sum("transaction_count").alias("transaction_count"),
        total2(exact("total_revenue")).alias("total_revenue"),
        mean_of_means2("avg_transaction_value").alias("avg_transaction_value"),
    )


def status_summary(a7: DataFrame) -> DataFrame:
    """status/region totals; ``revenue_at_risk`` is renamed ``total_revenue``."""
    return a7.groupBy("status", "region").agg(
        F.sum("order_count").alias("order_count"),
        total2(exact("revenue_at_risk")).alias("total_revenue"),
    )


def record_counts(regional: DataFrame, category: DataFrame, trends: DataFrame, top_products: DataFrame,
                  customer: DataFrame, payment: DataFrame, status: DataFrame) -> DataFrame:
    """Row counts of the seven list sections, as one row (one union + one aggregate)."""
    parts = [regional, category, trends, top_products, customer, payment, status]
    tagged = None
    for name, df in zip(RECORD_COUNT_FIELDS, parts):
        t = df.select(F.lit(name).alias("section"))
        tagged = t if tagged is None else tagged.unionAll(t)
    return tagged.agg(*[F.count_if(F.col("section") == n).alias(n) for n in RECORD_COUNT_FIELDS])
