"""Sales facts derived from the TPC-H-like tables, as clean typed rows and as dirty raw text.

``sales_view`` maps one lineitem to one sales line (star join over orders, customer,
nation, region and part). ``raw_view`` renders it as the all-STRING raw form and injects
the kinds of dirt the cleaner must handle, chosen by a hash bucket of the line's keys, so
the work grows with the tables and the result does not depend on partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURE_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")
# extra lineage columns kept in the raw view (deterministic dedup tie-break)
LINEAGE_COLUMNS = ("l_linenumber", "l_suppkey")
# dedup tie-break of the fixture (FIXTURES.md §4): source line, supplier, then quantity;
# every remaining column follows, so the order is total
FIXTURE_TIES = (*LINEAGE_COLUMNS, "quantity")
# layouts used to render dates, chosen by bucket % 4 (the four layouts the cleaner accepts)
RENDER_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")
BUCKETS = 200


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, clean sales lines (one per lineitem)."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("l_status"), "l_shipdate")
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")

    # joins drop rows without a key before they are dealt by it (a null key would gather in one task)
    li = li.dropna(subset=["l_orderkey", "l_partkey"])
    orders, customer = orders.dropna(subset=["o_orderkey", "o_custkey"]), customer.dropna(subset=["c_custkey", "c_nationkey"])
    part = part.dropna(subset=["p_partkey"])
    # nation x region is tiny: Catalyst broadcasts it by its size
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    geo = geo.select("n_nationkey", "n_name", "r_name")
    cust = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    cust = cust.select("c_custkey", "n_name", "r_name")
    ords = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    # fact-to-fact join: both sides grow with the data, so shuffle both on the order key
    # (sort-merge). Without a hint, size estimates made from file sizes can pick the
    # lineitem side for broadcast and stream the few customer partitions instead.
    lines = li.join(ords.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    # part is a fraction of lineitem: Catalyst/AQE choose broadcast or shuffle by size
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))

    quantity = F.col("l_quantity").cast("int")
    unit_price = F.col("p_retailprice").cast("decimal(12,2)")
    discount = F.abs(F.col("l_discount").cast("decimal(4,2)"))
    sales_amount = F.round(quantity * unit_price * (F.lit(Decimal(1)) - discount), 2).cast("decimal(18,2)")
    margin_pct = F.lit(5) + (F.col("l_partkey") * 13 + F.col("l_suppkey") * 7) % 31
    return lines.select(
        F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        discount.alias("discount"),
        sales_amount.alias("sales_amount"),
        margin_pct.alias("margin_pct"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_status").alias("status"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    ).select(
        "*",
        F.round(F.col("sales_amount") * F.col("margin_pct") * F.lit(Decimal("0.01")), 2).cast("decimal(18,2)").alias("profit"),
        F.when(F.col("sales_amount") < 100, (F.col("l_orderkey") % 2501) * F.lit(Decimal("0.01")))
         .otherwise(F.lit(0)).cast("decimal(18,2)").alias("shipping_cost"),
    )


def _render_date(ts: Column, bucket: Column) -> Column:
    out = None
    for i, fmt in enumerate(RENDER_FORMATS):
        branch = F.date_format(ts, fmt)
        out = F.when(bucket % 4 == i, branch) if out is None else out.when(bucket % 4 == i, branch)
    return out


def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-STRING raw sales rows with injected dirt (see FIXTURES.md §3), plus lineage columns."""
    s = sales_view(spark, sf_dir)
    h = ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7
          + F.col("l_linenumber")) % BUCKETS)
    s = s.withColumn("_h", h)
    h = F.col("_h")
    txt = lambda c: F.col(c).cast("string")
    order_date = (F.when(h == 4, F.lit("not-a-date"))
                  .when(h == 9, F.lit("2001-1-5"))
                  .otherwise(_render_date(F.col("order_date"), h)))
    quantity = (F.when(h == 2, F.lit("-5")).when(h == 5, F.lit("0")).when(h == 12, F.lit("2.5"))
                .when(h == 18, F.lit("1e2")).when(h == 19, F.lit("5D")).otherwise(txt("quantity")))
    unit_price = (F.when(h == 3, F.lit("abc")).when(h == 10, F.lit("NaN")).when(h == 15, F.lit("0.00004"))
                  .when(h == 16, F.lit("1e15")).when(h == 20, F.lit("1e20")).otherwise(txt("unit_price")))
    inflated = F.round(F.col("sales_amount") * F.lit(Decimal("1.10")), 2).cast("decimal(18,2)").cast("string")
    return s.select(
        F.when(h == 0, F.lit("")).otherwise(F.col("order_id")).alias("order_id"),
        F.when(h == 1, F.lit("  ")).otherwise(F.col("customer_id")).alias("customer_id"),
        "product_id",
        "product_name",
        F.when(h == 11, F.lit("")).otherwise(F.col("category")).alias("category"),
        "sub_category",
        F.when(h == 8, F.concat(F.lit("  "), F.col("region"), F.lit("  "))).otherwise(F.col("region")).alias("region"),
        "country",
        order_date.alias("order_date"),
        _render_date(F.col("ship_date"), h).alias("ship_date"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        F.when(h == 6, F.lit("")).when(h == 13, F.lit("100")).when(h == 14, F.lit("150"))
         .otherwise(txt("discount")).alias("discount"),
        F.when(h == 7, inflated).when(h == 17, F.lit("1e15")).otherwise(txt("sales_amount")).alias("sales_amount"),
        txt("profit").alias("profit"),
        txt("shipping_cost").alias("shipping_cost"),
        "payment_method",
        "status",
        *LINEAGE_COLUMNS,
    )
