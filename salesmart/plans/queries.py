"""Named queries over the driver's tables: one per operator of the inventory.

Every query derives its sales rows from the given tables (``raw_view``: one dirty raw
sales line per lineitem), so its work grows with them. Parameters that the original took
from the clock (today, now, a fresh run id) are fixed here so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.numeric import to_edge
from salesmart.operators import clean as C
from salesmart.operators import kpis as K
from salesmart.operators import summary as B
from salesmart.operators.windows import mom_growth, top_n_per_group
from salesmart.plans.jobs import Run, clean_by_months, of_leading_products, run_aggregate, stage3_sections, write_clean_months
from salesmart.schema import INVALID_NUMERIC, MISSING_REQUIRED, UNPARSEABLE_NUMERIC
from salesmart.session import scratch_path
from salesmart.sources.fixtures import FIXTURE_TIES, LINEAGE_COLUMNS, raw_view

# fixture parameters (FIXTURES.md §4): the driver's data spans 1992-2001, so the
# recency day and value thresholds are scaled to it
AS_OF = "2001-08-01"
HIGH, MID, ACTIVE, AT_RISK = 1_100_000, 700_000, 90, 365
RUN_TS = _dt.datetime(2001, 8, 1, 0, 0, 0)
RUN_ID = "fixture-run"
JOB = "salesmart"

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, d: str) -> DataFrame:
    return raw_view(spark, d)


def tagged(spark: SparkSession, d: str) -> DataFrame:
    return C.tag_quality(raw(spark, d))


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return C.clean(raw(spark, d), ties=FIXTURE_TIES)


def stored(spark: SparkSession, d: str) -> DataFrame:
    """``cleaned`` from staged months, for what reads it more than once; they stay below ``spark.checkpoint.dir``."""
    return clean_by_months(spark, tagged(spark, d), scratch_path(spark, "valid"), ties=FIXTURE_TIES)[0]


def leading(spark: SparkSession, d: str) -> DataFrame:
    """The lines of ``stored`` that can be in A4."""
    sales = stored(spark, d)
    some = of_leading_products(sales, scratch_path(spark, "leading"))
    return sales if some is None else some


def a5(spark, d):
    return K.customer_segments(cleaned(spark, d), as_of=AS_OF, high=HIGH, mid=MID, active=ACTIVE, at_risk=AT_RISK)


def _edge(fn: Query) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return to_edge(fn(spark, d))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


# --- cleaning --------------------------------------------------------------

def q_trim_blank_to_null(spark, d):
    return C.standardize_text(raw(spark, d))


def q_cast_numeric(spark, d):
    return C.cast_numeric(C.standardize_text(raw(spark, d)))


def q_parse_dates(spark, d):
    return C.parse_dates(C.standardize_text(raw(spark, d)))


def q_quality_tags(spark, d):
    return tagged(spark, d)


def q_sales_reconciliation(spark, d):
    return tagged(spark, d).select("order_id", "product_id", *LINEAGE_COLUMNS, "quantity", "unit_price",
                                   "discount", "sales_amount", "sales_amount_calc", "sales_amount_flag")


def q_valid_required(spark, d):
    return C.valid_required(C.standardize_text(raw(spark, d)))


def _quarantine_of(reason):
    def q(spark, d):
        return C.quarantine(raw(spark, d), RUN_TS).filter(F.col("quarantine_reason") == reason)
    return q


def q_valid_numeric(spark, d):
    """F1 then F4: rows tagged ok (required fields present, both numbers positive)."""
    return tagged(spark, d).filter(F.col("quality") == "ok").drop("quality")


def q_quarantine_all(spark, d):
    return C.quarantine(raw(spark, d), RUN_TS)


def q_dedup_latest(spark, d):
    return cleaned(spark, d).drop("year", "month")


def q_period_columns(spark, d):
    return cleaned(spark, d).select("order_id", "product_id", "order_date", "year", "month")


def q_undated_rows(spark, d):
    return C.undated_rows(cleaned(spark, d))


def q_distinct_regions(spark, d):
    return cleaned(spark, d).select("region").distinct()


def q_reconciliation_summary(spark, d):
    from salesmart.operators.quality import reconciliation_summary
    return reconciliation_summary(cleaned(spark, d))


def q_run_metrics(spark, d):
    from salesmart.operators.quality import run_metrics
    return run_metrics(tagged(spark, d))


# --- stage 2 ---------------------------------------------------------------

def q_region_country_monthly(spark, d):
    return K.region_country_monthly(cleaned(spark, d))


def q_category_monthly(spark, d):
    return K.category_monthly(cleaned(spark, d))


def q_monthly_trend(spark, d):
    return K.monthly_trend(cleaned(spark, d))


def q_mom_growth_calendar(spark, d):
    return K.monthly_trend(cleaned(spark, d), calendar=True)


def q_mom_growth(spark, d):
    """W2 on another grain: monthly revenue per (region, country)."""
    base = cleaned(spark, d).groupBy("region", "country", "year", "month").agg(
        K.total2("sales_amount").alias("revenue"))
    return mom_growth(base, "revenue", ("region", "country"), ("year", "month"))


def q_product_region_totals(spark, d):
    return K.product_region_totals(cleaned(spark, d))


def q_top_products_by_region(spark, d):
    return K.top_products_by_region(leading(spark, d))


def q_top_products_row_number(spark, d):
    """W3 with ``row_number``: exactly 10 products per region, ties cut deterministically."""
    return K.top_products_by_region(cleaned(spark, d), method="row_number")


def q_top_n_per_group(spark, d):
    """W3 on another grain: top 5 customers by revenue per country (dense rank)."""
    base = cleaned(spark, d).groupBy("country", "customer_id").agg(K.total2("sales_amount").alias("revenue"))
    return top_n_per_group(base, "country", [F.col("revenue").desc_nulls_last()], 5, "dense_rank", "rank")


def q_customer_segments(spark, d):
    return a5(spark, d)


def q_payment_distribution(spark, d):
    return K.payment_distribution(cleaned(spark, d))


def q_order_status_summary(spark, d):
    return K.order_status_summary(cleaned(spark, d))


def q_overall_kpi(spark, d):
    return K.overall_kpi(cleaned(spark, d))


def q_regional_grouping_sets(spark, d):
    return K.regional_grouping_sets(stored(spark, d))


def q_category_rollup(spark, d):
    return K.category_rollup(stored(spark, d))


def q_order_sketches(spark, d):
    """Per-month sketches, checked against the exact count (within 3 % or 2 orders)."""
    s = K.order_sketches(cleaned(spark, d))
    est = F.hll_sketch_estimate("orders_sketch")
    return s.select("region", "year", "month", "total_orders",
                    (F.abs(est - F.col("total_orders")) <= F.greatest(F.lit(2.0), F.col("total_orders") * 0.03))
                    .alias("sketch_within_bound"))


def q_sketch_merge(spark, d):
    """X3 merged: regional distinct orders from the monthly sketches, checked against the exact count."""
    sales = cleaned(spark, d)
    merged = K.sketch_rollup(K.order_sketches(sales))
    exact = sales.groupBy(F.col("region").alias("r")).agg(F.count_distinct("order_id").alias("total_orders"))
    off = F.abs(F.col("approx_orders") - F.col("total_orders"))
    return merged.join(exact, F.col("region").eqNullSafe(F.col("r"))).select(
        "region", "total_orders", (off <= F.greatest(F.lit(2.0), F.col("total_orders") * 0.05)).alias("merged_within_bound"))


# --- stage 3 ---------------------------------------------------------------

def q_regional_summary(spark, d):
    return B.regional_summary(K.region_country_monthly(cleaned(spark, d)))


def q_category_summary(spark, d):
    return B.category_summary(K.category_monthly(cleaned(spark, d)))


def q_monthly_trends(spark, d):
    return B.monthly_trends(K.monthly_trend(cleaned(spark, d)))


def q_segment_status_summary(spark, d):
    return B.segment_status_summary(a5(spark, d))


def q_segment_totals(spark, d):
    return B.segment_totals(a5(spark, d))


def q_payment_summary(spark, d):
    return B.payment_summary(K.payment_distribution(cleaned(spark, d)))


def q_status_summary(spark, d):
    return B.status_summary(K.order_status_summary(cleaned(spark, d)))


RUN = Run(RUN_ID, RUN_TS, JOB)


def kpi_tables(spark, d, base: str) -> None:
    """Stages 1 and 2 into ``base``: the cleaned columns that KPIs read, then the eight KPI tables."""
    write_clean_months(spark, tagged(spark, d), f"{base}/cleaned", ties=FIXTURE_TIES,
                       finish=lambda df: df.select(*K.KPI_INPUT_COLUMNS))
    run_aggregate(spark, f"{base}/cleaned", f"{base}/aggregated", RUN, as_of=AS_OF,
                  thresholds=dict(high=HIGH, mid=MID, active=ACTIVE, at_risk=AT_RISK))


def sections(spark, d) -> dict[str, DataFrame]:
    """The seven list sections of the report plus its inputs, from KPI tables written and read back."""
    base = scratch_path(spark, "report")
    kpi_tables(spark, d, base)
    return stage3_sections(spark, f"{base}/aggregated")


def q_record_counts(spark, d):
    s = sections(spark, d)
    return B.record_counts(s["regional_summary"], s["category_summary"], s["monthly_trends"], s["top_products"],
                           s["customer_segments"], s["payment_distribution"], s["order_status_summary"])


QUERIES: dict[str, Query] = {
    # sources / projections / filters / windows of stage 1
    "trim_blank_to_null": q_trim_blank_to_null,
    "cast_numeric": q_cast_numeric,
    "parse_dates": q_parse_dates,
    "quality_tags": q_quality_tags,
    "sales_reconciliation": q_sales_reconciliation,
    "valid_required": q_valid_required,
    "quarantine_missing": _quarantine_of(MISSING_REQUIRED),
    "quarantine_invalid": _quarantine_of(INVALID_NUMERIC),
    "quarantine_unparseable": _quarantine_of(UNPARSEABLE_NUMERIC),
    "valid_numeric": q_valid_numeric,
    "quarantine_all": q_quarantine_all,
    "dedup_latest": q_dedup_latest,
    "period_columns": q_period_columns,
    "undated_rows": q_undated_rows,
    "distinct_regions": q_distinct_regions,
    "reconciliation_summary": q_reconciliation_summary,
    "run_metrics": q_run_metrics,
    # stage 2
    "region_country_monthly": q_region_country_monthly,
    "category_monthly": q_category_monthly,
    "monthly_trend": q_monthly_trend,
    "mom_growth": q_mom_growth,
    "mom_growth_calendar": q_mom_growth_calendar,
    "product_region_totals": q_product_region_totals,
    "top_products_by_region": q_top_products_by_region,
    "top_n_per_group": q_top_n_per_group,
    "top_products_row_number": q_top_products_row_number,
    "customer_segments": q_customer_segments,
    "payment_distribution": q_payment_distribution,
    "order_status_summary": q_order_status_summary,
    "overall_kpi": q_overall_kpi,
    "regional_grouping_sets": q_regional_grouping_sets,
    "category_rollup": q_category_rollup,
    "order_sketches": q_order_sketches,
    "sketch_merge": q_sketch_merge,
    # stage 3
    "regional_summary": q_regional_summary,
    "category_summary": q_category_summary,
    "monthly_trends": q_monthly_trends,
    "segment_status_summary": q_segment_status_summary,
    "segment_totals": q_segment_totals,
    "payment_summary": q_payment_summary,
    "status_summary": q_status_summary,
    "record_counts": q_record_counts,
}

def _all() -> dict[str, Query]:
    from salesmart.plans.io_queries import IO_QUERIES
    return {k: _edge(v) for k, v in {**QUERIES, **IO_QUERIES}.items()}


QUERIES = _all()
