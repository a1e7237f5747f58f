"""Synthetic raw sales as a Spark job (G1) with injected dirt.

One output row per input row id, so the volume follows whatever table feeds the ids (the
registered query uses lineitem keys). Every random choice is a keyed hash of
(seed, row id, field), so the result is the same under any partitioning and rerun.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schema import RAW_COLUMNS

# ---------------------------------------------------------------------------
# fixed values: reference data of the sample-sales generator
# ---------------------------------------------------------------------------
REGIONS = {
    "North America": ["United States", "Canada", "Mexico"],
    "Europe": ["United Kingdom", "Germany", "France", "Italy", "Spain", "Netherlands"],
    "Asia Pacific": ["India", "Japan", "Australia", "Singapore", "South Korea"],
    "Latin America": ["Brazil", "Argentina", "Colombia", "Chile"],
    "Middle East": ["UAE", "Saudi Arabia", "Israel"],
}
CATEGORIES = {
    "Electronics": {
        "Computers": [("Laptop Pro 15", 1200), ("Gaming Laptop", 1800), ("Ultrabook X1", 999),
                      ("Workstation Z", 2500), ("Chromebook Air", 399)],
        "Smartphones": [("PhoneX 14", 999), ("Galaxy S23", 849), ("Pixel 8", 699),
                        ("Budget Phone", 199), ("Flagship Plus", 1199)],
        "Accessories": [("Wireless Earbuds", 149), ("USB-C Hub", 49), ("Mechanical Keyboard", 129),
                        ("Gaming Mouse", 79), ("4K Webcam", 89)],
    },
    "Clothing": {
        "Men": [("Formal Shirt", 45), ("Denim Jeans", 65), ("Casual Tee", 25),
                ("Wool Sweater", 89), ("Sports Shorts", 35)],
        "Women": [("Floral Dress", 75), ("Blazer", 120), ("Yoga Pants", 55),
                  ("Summer Top", 30), ("Evening Gown", 250)],
        "Footwear": [("Running Shoes", 110), ("Leather Boots", 180), ("Sandals", 45),
                     ("Casual Sneakers", 75), ("Formal Oxford", 145)],
    },
    "Home & Kitchen": {
        "Appliances": [("Air Fryer", 89), ("Coffee Maker", 49), ("Instant Pot", 99),
                       ("Stand Mixer", 299), ("Toaster Oven", 65)],
        "Furniture": [("Office Chair", 249), ("Standing Desk", 399), ("Bookshelf", 149),
                      ("Sofa Set", 899), ("Dining Table", 499)],
        "Bedding": [("Memory Foam Mattress", 599), ("Duvet Set", 89), ("Pillow Pack", 45),
                    ("Bed Frame", 299), ("Electric Blanket", 69)],
    },
    "Sports & Fitness": {
        "Equipment": [("Yoga Mat", 35), ("Resistance Bands", 25), ("Dumbbell Set", 149),
                      ("Treadmill", 799), ("Rowing Machine", 499)],
        "Outdoor": [("Camping Tent", 199), ("Hiking Boots", 149), ("Bicycle", 599),
                    ("Kayak", 899), ("Sleeping Bag", 79)],
    },
    "Books & Media": {
        "Books": [("Python Programming", 39), ("Data Science Handbook", 55),
                  ("Cloud Architecture", 49), ("Fiction Bestseller", 15), ("History Vol 1", 25)],
        "Software": [("Office Suite", 149), ("Design Tool", 599), ("Security Suite", 49),
                     ("Video Editor", 299), ("Cloud Storage 1TB", 99)],
    },
}
PAYMENT_METHODS = ["Credit Card", "Debit Card", "PayPal", "Bank Transfer", "Crypto", "Gift Card"]
ORDER_STATUSES = ["Delivered", "Delivered", "Delivered", "Shipped", "Processing",
                  "Cancelled", "Returned", "Pending"]
QUANTITIES, QUANTITY_WEIGHTS = [1, 2, 3, 5, 10], [50, 25, 15, 7, 3]
DISCOUNTS, DISCOUNT_WEIGHTS = [0.0, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30], [40, 20, 15, 10, 8, 5, 2]
START_DATE, END_DATE = "2021-01-01", "2024-12-31"
PRICE_SPREAD = 0.20                 # unit price = base price * U(0.8, 1.2)
MARGIN_MIN, MARGIN_MAX = 0.05, 0.35
SHIPPING_MAX, SHIPPING_BELOW = 25, 100
DIRT_KINDS = ("blank_order_id", "blank_customer_id", "negative_quantity", "text_price", "bad_date")


def _u(seed: int, field: str, ids: Sequence[Column]) -> Column:
    """Uniform [0, 1) from the first 52 bits of the MD5 of ``seed|field|row id``, which any engine can compute."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(field), *[c.cast("string") for c in ids]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _pick(u: Column, values: list) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def _weighted(u: Column, values: list, weights: list) -> Column:
    total, acc, out = float(sum(weights)), 0.0, None
    for v, w in zip(values, weights):
        acc += w / total
        out = F.when(u < acc, F.lit(v)) if out is None else out.when(u < acc, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


def synth_sales(ids: DataFrame, seed: int = 42) -> DataFrame:
    """G1: one all-STRING raw sales row per row of ``ids`` (its columns form the row id)."""
    key = [F.col(c) for c in ids.columns]
    u = lambda f: _u(seed, f, key)
    regions = list(REGIONS)
    # region -> country and category -> sub-category -> product, uniform at each level
    region = _pick(u("region"), regions)
    countries = F.element_at(F.create_map(*[x for r in regions for x in (F.lit(r), F.array(*map(F.lit, REGIONS[r])))]),
                             region)
    country = F.element_at(countries, (F.floor(u("country") * F.size(countries)) + 1).cast("int"))
    cats = list(CATEGORIES)
    category = _pick(u("category"), cats)
    subs = F.element_at(F.create_map(*[x for c in cats for x in (F.lit(c), F.array(*map(F.lit, CATEGORIES[c])))]),
                        category)
    sub = F.element_at(subs, (F.floor(u("sub") * F.size(subs)) + 1).cast("int"))
    products = F.create_map(*[x for c in cats for s, ps in CATEGORIES[c].items() for x in (
        F.lit(s), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("price")) for n, p in ps]))])
    product = F.element_at(F.element_at(products, sub), (F.floor(u("product") * 5) + 1).cast("int"))

    unit_price = F.round(product["price"] * (F.lit(1 - PRICE_SPREAD) + u("price") * (2 * PRICE_SPREAD)), 2)
    quantity = _weighted(u("quantity"), QUANTITIES, QUANTITY_WEIGHTS)
    discount = _weighted(u("discount"), DISCOUNTS, DISCOUNT_WEIGHTS)
    sales = F.round(quantity * unit_price * (F.lit(1) - discount), 2)
    profit = F.round(sales * (F.lit(MARGIN_MIN) + u("margin") * (MARGIN_MAX - MARGIN_MIN)), 2)
    shipping = F.round(F.when(sales < SHIPPING_BELOW, u("ship_cost") * SHIPPING_MAX).otherwise(0.0), 2)
    span = F.datediff(F.lit(END_DATE).cast("date"), F.lit(START_DATE).cast("date")) + 1
    order_date = F.date_add(F.lit(START_DATE).cast("date"), F.floor(u("date") * span).cast("int"))
    ship_date = F.date_add(order_date, (F.floor(u("ship_days") * 7) + 1).cast("int"))
    order_hex = F.upper(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]), 256), 1, 12))
    out = ids.select(
        F.concat(F.lit("ORD-"), order_hex).alias("order_id"),
        F.format_string("CUST-%05d", (F.floor(u("customer") * (99999 - 1000 + 1)) + 1000).cast("int")).alias("customer_id"),
        F.format_string("PROD-%04d", F.conv(F.substring(F.md5(product["name"]), 1, 8), 16, 10).cast("bigint") % 10000).alias("product_id"),
        product["name"].alias("product_name"), category.alias("category"), sub.alias("sub_category"),
        region.alias("region"), country.alias("country"),
        F.date_format(order_date, "yyyy-MM-dd").alias("order_date"),
        F.date_format(ship_date, "yyyy-MM-dd").alias("ship_date"),
        quantity.alias("quantity"), unit_price.alias("unit_price"), discount.alias("discount"),
        sales.alias("sales_amount"), profit.alias("profit"), shipping.alias("shipping_cost"),
        _pick(u("payment"), PAYMENT_METHODS).alias("payment_method"),
        _pick(u("status"), ORDER_STATUSES).alias("status"),
    )
    return out.select([F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])


def with_dirt(raw: DataFrame, fraction: float = 0.02, seed: int = 42, id_cols: Sequence[str] = ("order_id",)) -> DataFrame:
    """Append dirty rows, one for each of a hash-chosen ``fraction`` of the rows, with one of five defects each.

    They are rows of their own: a new order id, so dedup doesn't drop them in favour of the rows they resemble.
    """
    key = [F.col(c) for c in id_cols]
    chosen = raw.filter(_u(seed, "dirt", key) < fraction)
    kind = F.floor(_u(seed, "dirt_kind", key) * len(DIRT_KINDS)).cast("int")
    own = F.concat(F.lit("ORD-"), F.upper(F.substring(F.sha2(F.concat_ws("|", F.lit("dirt"), *key), 256), 1, 12)))
    dirty = chosen.select(
        F.when(kind == 0, F.lit("")).otherwise(own).alias("order_id"),
        F.when(kind == 1, F.lit("  ")).otherwise(F.col("customer_id")).alias("customer_id"),
        *[F.col(c) for c in RAW_COLUMNS[2:8]],
        F.when(kind == 4, F.lit("not-a-date")).otherwise(F.col("order_date")).alias("order_date"),
        F.col("ship_date"),
        F.when(kind == 2, F.lit("-5")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(kind == 3, F.lit("abc")).otherwise(F.col("unit_price")).alias("unit_price"),
        *[F.col(c) for c in RAW_COLUMNS[12:]],
    )
    return raw.unionByName(dirty)


def generate_csv(spark: SparkSession, rows: int, path: str, dirt: float = 0.02, seed: int = 42) -> str:
    """``rows`` synthetic sales and their dirty rows as header CSV files under ``path``, written by all tasks."""
    raw = with_dirt(synth_sales(spark.range(rows).withColumnRenamed("id", "row_id"), seed), dirt, seed)
    (raw.write.mode("overwrite").option("header", "true").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path
