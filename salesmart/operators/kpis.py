"""Stage 2: KPI tables over the cleaned fact (A1-A8) and exact multi-grain variants.

Each function is ``cleaned -> KPI table``; money totals are exact DECIMAL(38,2), means and
percentages DOUBLE rounded to 2 places (see ``functions.numeric``). Every aggregate is a
partial (map-side) + final hash aggregate, so a hot group key is pre-combined before the
shuffle; ``count_distinct`` adds one level keyed by (group, value), which spreads a hot
group's distinct values over all shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import mean2, ratio, ratio_pct, total2
from salesmart.operators.windows import mom_growth, top_n_per_group
from salesmart.schema import (
    ACTIVE_MAX_DAYS, AT_RISK_MAX_DAYS, HIGH_VALUE_MIN, MID_VALUE_MIN, MONEY, SEGMENT_HIGH, SEGMENT_LOW,
    SEGMENT_MID, STATUS_ACTIVE, STATUS_AT_RISK, STATUS_CHURNED, TOP_N,
)

# columns any KPI reads from the cleaned fact (select these before caching)
KPI_INPUT_COLUMNS = (
    "order_id", "customer_id", "product_id", "product_name", "category", "sub_category", "region",
    "country", "order_date", "quantity", "unit_price", "discount", "sales_amount", "profit",
    "payment_method", "status", "year", "month",
)


def _money_block(orders: str = "total_orders"):
    return [
        total2("sales_amount").alias("total_revenue"),
        total2("profit").alias("total_profit"),
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("order_id").alias(orders),
    ]


def region_country_monthly(sales: DataFrame) -> DataFrame:
    """A1: revenue, profit, units, orders, mean line amount and margin by region/country/month."""
    return sales.groupBy("region", "country", "year", "month").agg(
        *_money_block(),
        mean2("sales_amount").alias("avg_order_value"),
        ratio_pct(F.sum("profit"), F.sum("sales_amount")).alias("profit_margin_pct"),
    )


def category_monthly(sales: DataFrame) -> DataFrame:
    """A2: as A1 by category/sub-category/month, with the mean discount in percent."""
    return sales.groupBy("category", "sub_category", "year", "month").agg(
        *_money_block(),
        F.round(F.try_divide(F.sum("discount").cast("double"), F.count("discount")) * 100, 2)
         .alias("avg_discount_pct"),
        ratio_pct(F.sum("profit"), F.sum("sales_amount")).alias("profit_margin_pct"),
    )


def monthly_totals(sales: DataFrame) -> DataFrame:
    """A3 without the growth."""
    return sales.groupBy("year", "month", "region").agg(
        total2("sales_amount").alias("monthly_revenue"),
        total2("profit").alias("monthly_profit"),
        F.sum("quantity").alias("monthly_units"),
        F.count_distinct("order_id").alias("monthly_orders"),
    )


def monthly_trend(sales: DataFrame, calendar: bool = False) -> DataFrame:
    """A3: monthly totals per region with month-over-month revenue growth."""
    return with_growth(monthly_totals(sales), calendar)


def with_growth(totals: DataFrame, calendar: bool = False) -> DataFrame:
    """The growth column of A3 beside ``monthly_totals``."""
    return mom_growth(totals, "monthly_revenue", ("region",), ("year", "month"), calendar=calendar)


PRODUCT_KEYS = ("region", "product_id", "product_name", "category", "sub_category")


def product_region_totals(sales: DataFrame) -> DataFrame:
    """Unranked product totals per region."""
    return sales.groupBy(*PRODUCT_KEYS).agg(
        *_money_block(),
        mean2("unit_price").alias("avg_unit_price"),
    )


def top_products_by_region(sales: DataFrame, n: int = TOP_N, method: str = "rank") -> DataFrame:
    """A4: products ranked by (rounded) revenue within their region, rank <= n."""
    return ranked_products(product_region_totals(sales), n, method)


def ranked_products(totals: DataFrame, n: int = TOP_N, method: str = "rank") -> DataFrame:
    """A4 from ``product_region_totals``."""
    return top_n_per_group(totals, "region", [F.col("total_revenue").desc_nulls_last()], n, method, "rank_in_region")


def product_bounds(sales: DataFrame) -> DataFrame:
    """``region, product, most``: a number for each group of A4b (equal groups have the same, and others hardly ever), and the revenue of
    its lines above zero, so no group of that number has a greater total."""
    positive = F.greatest(F.col("sales_amount"), F.lit(0).cast(MONEY))      # NULL amounts count as nothing
    return sales.groupBy("region", F.xxhash64(*PRODUCT_KEYS).alias("product")).agg(total2(positive).alias("most"))


def leading_products(bounds: DataFrame, sales: DataFrame, kept: Callable[[DataFrame, str], DataFrame], n: int = TOP_N) -> DataFrame:
    """The numbers of ``product_bounds`` that may be among the first ``n`` of A4 (ties included) in a region.

    The n-th total among the groups of the n greatest bounds is at most the region's n-th total, so a group with a lesser bound can't
    be among the first. Where fewer than n of them have a total, all of the region's may be (and one whose bound DECIMAL can't hold). ``kept`` stores a small table.
    """
    first = top_n_per_group(bounds, "region", [F.col("most").desc_nulls_last()], n, "row_number").select("product")
    totals = of_products(sales, kept(first, "first")).groupBy(*PRODUCT_KEYS).agg(total2("sales_amount").alias("total"))
    nth = top_n_per_group(totals, "region", [F.col("total").desc_nulls_last()], n, "row_number") \
        .groupBy("region").agg(F.when(F.count("total") >= n, F.min("total")).alias("nth"))
    nth = kept(nth.withColumnRenamed("region", "in_region"), "nth")
    return bounds.join(nth, F.col("region").eqNullSafe(F.col("in_region")), "left") \
        .filter(F.col("nth").isNull() | F.col("most").isNull() | (F.col("most") >= F.col("nth"))).select("product").distinct()


def of_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    """The lines whose A4b group has one of the numbers."""
    return sales.join(products, F.xxhash64(*PRODUCT_KEYS) == F.col("product"), "left_semi")


def customer_totals(sales: DataFrame) -> DataFrame:
    """A5 without what depends on the day: totals per (customer, region, country)."""
    return sales.groupBy("customer_id", "region", "country").agg(
        total2("sales_amount").alias("lifetime_value"),
        F.count_distinct("order_id").alias("total_orders"),
        mean2("sales_amount").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        total2("profit").alias("total_profit_generated"),
    )


def customer_segments(sales: DataFrame, as_of=None, high=HIGH_VALUE_MIN, mid=MID_VALUE_MIN,
                      active=ACTIVE_MAX_DAYS, at_risk=AT_RISK_MAX_DAYS) -> DataFrame:
    """A5: value segment and recency status per (customer, region, country).

    ``as_of`` (date or 'yyyy-MM-dd'; default today) fixes the recency reference day, so a
    rerun gives the same table. NULL lifetime value -> LOW_VALUE, NULL recency -> CHURNED.
    """
    return with_segments(customer_totals(sales), as_of, high, mid, active, at_risk)


def with_segments(totals: DataFrame, as_of=None, high=HIGH_VALUE_MIN, mid=MID_VALUE_MIN,
                  active=ACTIVE_MAX_DAYS, at_risk=AT_RISK_MAX_DAYS) -> DataFrame:
    """The segment and status columns of A5 beside ``customer_totals``."""
    as_of_col = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    lv = F.col("lifetime_value")
    days = F.datediff(as_of_col, F.to_date("last_order_date"))
    return (totals.withColumn("customer_segment",
                         F.when(lv >= high, F.lit(SEGMENT_HIGH)).when(lv >= mid, F.lit(SEGMENT_MID))
                         .otherwise(F.lit(SEGMENT_LOW)))
             .withColumn("days_since_last_order", days)
             .withColumn("customer_status",
                         F.when(F.col("days_since_last_order") <= active, F.lit(STATUS_ACTIVE))
                         .when(F.col("days_since_last_order") <= at_risk, F.lit(STATUS_AT_RISK))
                         .otherwise(F.lit(STATUS_CHURNED))))


def payment_distribution(sales: DataFrame) -> DataFrame:
    """Transactions, revenue and mean amount by payment method/region/month."""
    return sales.groupBy("payment_method", "region", "year", "month").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        total2("sales_amount").alias("total_revenue"),
        mean2("sales_amount").alias("avg_transaction_value"),
    )


def order_status_summary(sales: DataFrame) -> DataFrame:
    """Lines and revenue by order status/region/month (``revenue_at_risk`` sums every status)."""
    return sales.groupBy("status", "region", "year", "month").agg(
        F.count(F.lit(1)).alias("order_count"),
        total2("sales_amount").alias("revenue_at_risk"),
    )


def overall_kpi(sales: DataFrame) -> DataFrame:
    """One row of grand totals (margin here is mean(profit)/mean(sales), as the original)."""
    mean = lambda c: F.try_divide(F.sum(c).cast("double"), F.count(c))
    return sales.agg(
        total2("sales_amount").alias("grand_total_revenue"),
        total2("profit").alias("grand_total_profit"),
        F.round(F.try_divide(mean("profit"), mean("sales_amount")) * 100, 2).alias("overall_profit_margin_pct"),
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
        mean2("sales_amount").alias("avg_order_value"),
        F.min("order_date").alias("data_from"),
        F.max("order_date").alias("data_to"),
    )


# tables with orders counted per group: the groups' columns and the count's name
ORDERS_APART = {
    "region_country_monthly": (("region", "country", "year", "month"), "total_orders"),
    "category_monthly": (("category", "sub_category", "year", "month"), "total_orders"),
    "monthly_trend": (("year", "month", "region"), "monthly_orders"),
}


def orders_apart(fn: Callable[..., DataFrame], keys: Sequence[str], orders: str) -> Callable[..., DataFrame]:
    """``fn`` with the distinct orders counted by a scan of their own: an order's row is then shuffled without any totals, and
    the totals leave a map task as one row a group. For stored input, as it is scanned twice."""
    def apart(sales: DataFrame) -> DataFrame:
        totals = fn(sales.withColumn("order_id", F.lit(None).cast("string")))
        counts = sales.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count_distinct("order_id").alias("_orders"))
        same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        return totals.join(counts, same).select(*(F.col("_orders").alias(c) if c == orders else F.col(c) for c in totals.columns))
    return apart


OVERALL_IDS = ("order_id", "customer_id", "product_id")     # whose distinct values A8 counts


def monthly_sums(sales: DataFrame) -> DataFrame:
    """What A8 adds up, per month and unrounded, so that months can be added in any order."""
    return sales.groupBy("year", "month").agg(
        F.sum("sales_amount").alias("amount"), F.count("sales_amount").alias("amounts"),
        F.sum("profit").alias("gain"), F.count("profit").alias("gains"), F.sum("quantity").alias("units"),
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))


def overall_from_months(sums: DataFrame, distinct: DataFrame) -> DataFrame:
    """A8 from ``monthly_sums`` and the distinct counts (``column, n``, see ``operators.distinct``): the lines aren't read,
    and nothing is expanded."""
    both = sums.unionByName(distinct, allowMissingColumns=True)
    mean = lambda total, n: F.try_divide(F.sum(total).cast("double"), F.sum(n))
    count = lambda c: F.coalesce(F.max(F.when(F.col("column") == c, F.col("n"))), F.lit(0).cast("bigint"))
    orders, customers, products = (count(c) for c in OVERALL_IDS)
    return both.agg(
        total2("amount").alias("grand_total_revenue"),
        total2("gain").alias("grand_total_profit"),
        F.round(F.try_divide(mean("gain", "gains"), mean("amount", "amounts")) * 100, 2).alias("overall_profit_margin_pct"),
        F.sum("units").alias("total_units_sold"),
        orders.alias("total_orders"),
        customers.alias("unique_customers"),
        products.alias("unique_products"),
        F.round(mean("amount", "amounts"), 2).alias("avg_order_value"),
        F.min("first_date").alias("data_from"),
        F.max("last_date").alias("data_to"),
    )


# ---------------------------------------------------------------------------
# exact variants
# ---------------------------------------------------------------------------

def grain_parts(sales: DataFrame, *keys: str) -> DataFrame:
    """What the nested grains of ``keys`` (all of them, then without the last, ...) add up from groups of all ``keys``: sums of the
    lines, and per grain the distinct orders that count here.

    An order counts in one group of each grain's: where it is first in the order of ``keys``. So lines are dealt once, by
    order, without amounts; the sums leave a map task as one row a group. The input is scanned twice.
    """
    sums = sales.groupBy(*keys).agg(
        F.sum("sales_amount").alias("amount"), F.count("sales_amount").alias("amounts"), F.sum("profit").alias("gain"),
        F.sum("quantity").alias("units"), F.sum("discount").alias("share"), F.count("discount").alias("shares"))
    w = Window.partitionBy("order_id").orderBy(*keys)
    other = [F.lag(F.struct(*keys[:n])).over(w).eqNullSafe(F.struct(*keys[:n])) for n in range(1, len(keys) + 1)]
    names = [_orders_of(n) for n in range(len(keys) + 1)]
    first = sales.filter(F.col("order_id").isNotNull()).select("order_id", *keys).select(
        *keys, (F.row_number().over(w) == 1).alias(names[0]), *((~o).alias(n) for o, n in zip(other, names[1:], strict=True)))
    counts = first.groupBy(*keys).agg(*(F.count_if(n).alias(n) for n in names))
    return sums.unionByName(counts, allowMissingColumns=True)


def _orders_of(columns: int) -> str:
    return f"_orders_{columns}"


def _grain_block(columns: int):
    """``_money_block`` and revenue per order over ``grain_parts`` of so many keys, at each grain."""
    last = (1 << columns) - 1
    orders = F.lit(None).cast("bigint")
    for n in range(columns + 1):      # grouping_id of the grain that has the first n keys
        orders = F.when(F.grouping_id() == (last >> n), F.sum(_orders_of(n))).otherwise(orders)
    orders = F.coalesce(orders, F.lit(0).cast("bigint"))
    return ([total2("amount").alias("total_revenue"), total2("gain").alias("total_profit"), F.sum("units").alias("total_units_sold"),
             orders.alias("total_orders")], F.round(ratio(F.sum("amount"), orders), 2).alias("revenue_per_order"))


def regional_grouping_sets(sales: DataFrame) -> DataFrame:
    """Month, region/country, region and grand-total grains in one pass.

    Unlike re-aggregating monthly rows, distinct orders and means are exact at every grain;
    ``revenue_per_order`` is revenue / distinct orders. ``grain`` = ``grouping_id()``.
    """
    keys = ["region", "country", "year", "month"]
    block, per_order = _grain_block(len(keys))
    return grain_parts(sales, *keys).groupingSets([keys, keys[:2], keys[:1], []], *keys).agg(
        F.grouping_id().alias("grain"),
        *block,
        F.round(F.try_divide(F.sum("amount").cast("double"), F.sum("amounts")), 2).alias("avg_order_value"),
        ratio_pct(F.sum("gain"), F.sum("amount")).alias("profit_margin_pct"),
        per_order,
    )


def category_rollup(sales: DataFrame) -> DataFrame:
    """Category hierarchy totals (category/sub-category, category, all) in one pass."""
    keys = ["category", "sub_category"]
    block, per_order = _grain_block(len(keys))
    return grain_parts(sales, *keys).rollup(*keys).agg(
        F.grouping_id().alias("grain"),
        *block,
        F.round(F.try_divide(F.sum("share").cast("double"), F.sum("shares")) * 100, 2).alias("avg_discount_pct"),
        ratio_pct(F.sum("gain"), F.sum("amount")).alias("profit_margin_pct"),
        per_order,
    )


def order_sketches(sales: DataFrame, lg_k: int = 12) -> DataFrame:
    """Mergeable distinct-order sketches per (region, year, month).

    Sketches of several months/regions/runs merge with ``hll_union_agg`` and estimate with
    ``hll_sketch_estimate`` without rescanning the fact.
    """
    return sales.groupBy("region", "year", "month").agg(
        F.hll_sketch_agg("order_id", lg_k).alias("orders_sketch"),
        F.count_distinct("order_id").alias("total_orders"),
    )


def sketch_rollup(sketches: DataFrame, keys=("region",)) -> DataFrame:
    """Merge X3 sketches to a coarser grain and estimate distinct orders."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("orders_sketch")).alias("approx_orders"))


# ---------------------------------------------------------------------------
# registry: the stage-2 datasets, their output partitioning and audit column
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Kpi:
    fn: Callable[..., DataFrame]
    partitions: tuple[str, ...] = ()
    ts_col: str = "etl_ts"
    # bounded by dimension sizes (regions, categories, months...) rather than by entities
    # that grow with the data; only bounded tables get the small fixed file count
    bounded: bool = True


KPI_DATASETS: dict[str, Kpi] = {
    "region_country_monthly": Kpi(region_country_monthly, ("year", "month")),
    "category_monthly": Kpi(category_monthly, ("year", "month")),
    "monthly_trend": Kpi(monthly_trend),
    "top_products_by_region": Kpi(top_products_by_region),
    "customer_segments": Kpi(customer_segments, bounded=False),   # one row per customer
    "payment_distribution": Kpi(payment_distribution, ("year", "month")),
    "order_status_summary": Kpi(order_status_summary, ("year", "month")),
    "overall_kpi": Kpi(overall_kpi, (), "generated_at"),
}

