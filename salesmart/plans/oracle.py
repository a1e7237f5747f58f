"""Independent DuckDB SQL for every named query (the correctness oracle).

Written from the business rules, not from the Spark code: the same fixture, cleaning and
KPI semantics expressed as plain SQL over the driver's tables. Rounding follows the rule
of ``functions.numeric``; ``r2`` reproduces Spark's half-up rounding of a DOUBLE (via its
shortest decimal text).
"""

from __future__ import annotations

from salesmart.operators import synth as G
from salesmart.plans.queries import ACTIVE, AS_OF, AT_RISK, HIGH, JOB, MID, RUN_ID, RUN_TS
from salesmart.schema import RAW_COLUMNS, REQUIRED_FIELDS

LINEAGE = ("l_linenumber", "l_suppkey")


def r2(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def tot(x: str) -> str:
    """Exact money total, to DOUBLE at the edge."""
    return f"CAST(CAST(round(sum({x}), 2) AS DECIMAL(38,2)) AS DOUBLE)"


def tot_dec(x: str) -> str:
    return f"CAST(round(sum({x}), 2) AS DECIMAL(38,2))"


def mean(x: str) -> str:
    return r2(f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)")


def pct(a: str, b: str) -> str:
    return r2(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0) * 100")


def _render(ts: str) -> str:
    return (f"CASE h % 4 WHEN 0 THEN strftime({ts}, '%Y-%m-%d') WHEN 1 THEN strftime({ts}, '%m/%d/%Y') "
            f"WHEN 2 THEN strftime({ts}, '%d-%m-%Y') ELSE strftime({ts}, '%Y/%m/%d') END")


# date layouts: regex of the digit shape, then strptime (DuckDB alone would accept 2024-1-5)
_DATE_SHAPES = (
    (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
    (r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y"),
    (r"\d{2}-\d{2}-\d{4}", "%d-%m-%Y"),
    (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"),
)


def _date(c: str) -> str:
    parts = [f"CASE WHEN regexp_full_match({c}, '{rx}') THEN try_strptime({c}, '{fmt}') END"
             for rx, fmt in _DATE_SHAPES]
    return "coalesce(" + ", ".join(parts) + ")"


def _int(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"THEN TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER) END")


def _finite(c: str) -> str:
    return f"CASE WHEN abs(TRY_CAST({c} AS DOUBLE)) < 'inf'::DOUBLE THEN TRY_CAST({c} AS DOUBLE) END"


def _money(c: str) -> str:
    """Wider than the amounts that pass the size rule."""
    return f"CASE WHEN abs(TRY_CAST({c} AS DOUBLE)) < 1e18 THEN TRY_CAST({c} AS DECIMAL(38,10)) END"


_TYPED = {
    "quantity": _int("quantity"),
    "unit_price": _money("unit_price"),
    "discount": _money("discount"),
    "sales_amount": _money("sales_amount"),
    "profit": _money("profit"),
    "shipping_cost": _money("shipping_cost"),
}
_DATES = {"order_date": _date("order_date"), "ship_date": _date("ship_date")}

# amounts from 1e18 on have an own reason
_TOO_LARGE = " OR ".join(f"coalesce(abs({_finite(c)}) >= 1e18, FALSE)"
                         for c in ("unit_price", "discount", "sales_amount", "profit", "shipping_cost"))
_REQ = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_FIELDS)
_QUALITY = (
    f"CASE WHEN NOT ({_REQ}) THEN 'missing_required_field' "
    f"WHEN {_TYPED['quantity']} <= 0 OR {_finite('unit_price')} <= 0 THEN 'invalid_numeric' "
    f"WHEN {_TYPED['quantity']} > 0 AND {_finite('unit_price')} > 0 AND ({_TOO_LARGE}) THEN 'unrepresentable_amount' "
    f"WHEN {_TYPED['quantity']} > 0 AND {_finite('unit_price')} > 0 THEN 'ok' "
    f"ELSE 'unparseable_numeric' END"
)

# cleaned columns in order, and the dedup order: order_date desc, lineage, then the rest
CLEAN_COLS = (*RAW_COLUMNS, *LINEAGE, "sales_amount_calc", "sales_amount_flag")
_FIRST_TIES = (*LINEAGE, "quantity")
_TIES = [*_FIRST_TIES] + [c for c in CLEAN_COLS if c not in ("order_id", "product_id", "order_date", *_FIRST_TIES)]
_DEDUP_ORDER = "order_date DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS FIRST" for c in _TIES)

BASE = f"""
sales0 AS (
  SELECT 'ORD-' || CAST(l.l_orderkey AS VARCHAR) AS order_id,
         'CUST-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
         'PROD-' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         p.p_name AS product_name, p.p_type AS category, p.p_brand AS sub_category,
         r.r_name AS region, n.n_name AS country,
         o.o_orderdate AS order_ts, l.l_shipdate AS ship_ts,
         CAST(trunc(l.l_quantity) AS INTEGER) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
         abs(CAST(l.l_discount AS DECIMAL(4,2))) AS discount,
         o.o_orderpriority AS payment_method, l.l_returnflag || l.l_linestatus AS status,
         l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
sales1 AS (
  SELECT *, CAST(round(CAST(quantity AS DECIMAL(10,0)) * unit_price * CAST(1 - discount AS DECIMAL(5,2)), 2)
                 AS DECIMAL(18,2)) AS sales_amount
  FROM sales0
),
sales2 AS (
  SELECT *,
         CAST(round(sales_amount * (5 + (l_partkey * 13 + l_suppkey * 7) % 31) * 0.01, 2) AS DECIMAL(18,2)) AS profit,
         CAST(CASE WHEN sales_amount < 100 THEN (l_orderkey % 2501) * 0.01 ELSE 0 END AS DECIMAL(18,2)) AS shipping_cost,
         (l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber) % 200 AS h
  FROM sales1
),
raw AS (
  SELECT CASE WHEN h = 0 THEN '' ELSE order_id END AS order_id,
         CASE WHEN h = 1 THEN '  ' ELSE customer_id END AS customer_id,
         product_id, product_name,
         CASE WHEN h = 11 THEN '' ELSE category END AS category,
         sub_category,
         CASE WHEN h = 8 THEN '  ' || region || '  ' ELSE region END AS region,
         country,
         CASE WHEN h = 4 THEN 'not-a-date' WHEN h = 9 THEN '2001-1-5' ELSE {_render('order_ts')} END AS order_date,
         {_render('ship_ts')} AS ship_date,
         CASE WHEN h = 2 THEN '-5' WHEN h = 5 THEN '0' WHEN h = 12 THEN '2.5'
              WHEN h = 18 THEN '1e2' WHEN h = 19 THEN '5D' ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CASE WHEN h = 3 THEN 'abc' WHEN h = 10 THEN 'NaN' WHEN h = 15 THEN '0.00004'
              WHEN h = 16 THEN '1e15' WHEN h = 20 THEN '1e20' ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
         CASE WHEN h = 6 THEN '' WHEN h = 13 THEN '100' WHEN h = 14 THEN '150' ELSE CAST(discount AS VARCHAR) END AS discount,
         CASE WHEN h = 7 THEN CAST(CAST(round(sales_amount * 1.10, 2) AS DECIMAL(18,2)) AS VARCHAR)
              WHEN h = 17 THEN '1e15' ELSE CAST(sales_amount AS VARCHAR) END AS sales_amount,
         CAST(profit AS VARCHAR) AS profit,
         CAST(shipping_cost AS VARCHAR) AS shipping_cost,
         payment_method, status, l_linenumber, l_suppkey
  FROM sales2
),
std AS (
  SELECT {", ".join(f"nullif(trim({c}, ' '), '') AS {c}" for c in RAW_COLUMNS)}, l_linenumber, l_suppkey
  FROM raw
),
tagged0 AS (
  SELECT {", ".join(f"{_DATES.get(c) or _TYPED.get(c) or c} AS {c}" for c in RAW_COLUMNS)},
         l_linenumber, l_suppkey, {_QUALITY} AS quality
  FROM std
),
tagged1 AS (
  SELECT *, round(CAST(quantity AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(24,6))
                  * CAST(1 - coalesce(discount, 0) AS DECIMAL(24,6)), 2) AS sales_amount_calc
  FROM tagged0
),
tagged AS (
  SELECT *, CASE WHEN sales_amount_calc > 0 AND abs(sales_amount - sales_amount_calc) > sales_amount_calc * 0.01
                 THEN 'MISMATCH' ELSE 'OK' END AS sales_amount_flag
  FROM tagged1
),
clean AS (
  SELECT * EXCLUDE (rn), CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month
  FROM (SELECT * EXCLUDE (quality), row_number() OVER (PARTITION BY order_id, product_id ORDER BY {_DEDUP_ORDER}) AS rn
        FROM tagged WHERE quality = 'ok')
  WHERE rn = 1
)"""


def with_base(sql: str, extra: str = "") -> str:
    ctes = BASE + ("," + extra if extra else "")
    return f"WITH {ctes}\n{sql}"


_STD_COLS = ", ".join(RAW_COLUMNS)
_TYPED_EDGE = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in ("unit_price", "discount", "sales_amount", "profit", "shipping_cost") else c
    for c in RAW_COLUMNS)
_TAGGED_EDGE = f"{_TYPED_EDGE}, l_linenumber, l_suppkey, quality, CAST(sales_amount_calc AS DOUBLE) AS sales_amount_calc, sales_amount_flag"
_CLEAN_EDGE = f"{_TYPED_EDGE}, l_linenumber, l_suppkey, CAST(sales_amount_calc AS DOUBLE) AS sales_amount_calc, sales_amount_flag"
_RUN_TS = RUN_TS.strftime("%Y-%m-%d %H:%M:%S")


def _quarantine(where: str = "TRUE") -> str:
    cols = ", ".join(c for c in RAW_COLUMNS if c != "order_id")
    return with_base(f"""
SELECT order_id, quality AS quarantine_reason, TIMESTAMP '{_RUN_TS}' AS quarantine_ts, {cols}, l_linenumber, l_suppkey
FROM (SELECT *, {_QUALITY} AS quality FROM std)
WHERE quality <> 'ok' AND {where}""")


# --- stage 2 tables as CTEs (DECIMAL totals, DOUBLE 2-dp means) --------------

def _money_block(orders: str = "total_orders") -> str:
    return (f"{tot_dec('sales_amount')} AS total_revenue, {tot_dec('profit')} AS total_profit, "
            f"CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT order_id) AS {orders}")


A1 = f"""a1 AS (
  SELECT region, country, year, month, {_money_block()},
         {mean('sales_amount')} AS avg_order_value,
         {pct('sum(profit)', 'sum(sales_amount)')} AS profit_margin_pct
  FROM clean GROUP BY region, country, year, month)"""

A2 = f"""a2 AS (
  SELECT category, sub_category, year, month, {_money_block()},
         {r2("CAST(sum(discount) AS DOUBLE) / nullif(count(discount), 0) * 100")} AS avg_discount_pct,
         {pct('sum(profit)', 'sum(sales_amount)')} AS profit_margin_pct
  FROM clean GROUP BY category, sub_category, year, month)"""


def _growth(value: str, prev: str) -> str:
    return f"CASE WHEN {prev} IS NOT NULL AND {prev} > 0 THEN {pct(f'({value} - {prev})', prev)} END"


A3_BASE = f"""a3b AS (
  SELECT year, month, region, {tot_dec('sales_amount')} AS monthly_revenue, {tot_dec('profit')} AS monthly_profit,
         CAST(sum(quantity) AS BIGINT) AS monthly_units, count(DISTINCT order_id) AS monthly_orders
  FROM clean GROUP BY year, month, region)"""

A3 = A3_BASE + f""",
a3p AS (
  SELECT *, lag(monthly_revenue) OVER (PARTITION BY region ORDER BY year ASC NULLS FIRST, month ASC NULLS FIRST) AS prev
  FROM a3b),
a3 AS (SELECT * EXCLUDE (prev), {_growth('monthly_revenue', 'prev')} AS mom_growth_pct FROM a3p)"""

A4B = f"""a4b AS (
  SELECT region, product_id, product_name, category, sub_category, {_money_block()},
         {mean('unit_price')} AS avg_unit_price
  FROM clean GROUP BY region, product_id, product_name, category, sub_category)"""

A4 = A4B + """,
a4 AS (
  SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY region ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS rank_in_region FROM a4b)
  WHERE rank_in_region <= 10)"""

A5 = f"""a5b AS (
  SELECT customer_id, region, country, {tot_dec('sales_amount')} AS lifetime_value,
         count(DISTINCT order_id) AS total_orders, {mean('sales_amount')} AS avg_order_value,
         min(order_date) AS first_order_date, max(order_date) AS last_order_date,
         {tot_dec('profit')} AS total_profit_generated
  FROM clean GROUP BY customer_id, region, country),
a5d AS (
  SELECT *, CASE WHEN lifetime_value >= {HIGH} THEN 'HIGH_VALUE' WHEN lifetime_value >= {MID} THEN 'MID_VALUE' ELSE 'LOW_VALUE' END AS customer_segment,
         CAST(datediff('day', CAST(last_order_date AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order
  FROM a5b),
a5 AS (
  SELECT *, CASE WHEN days_since_last_order <= {ACTIVE} THEN 'ACTIVE' WHEN days_since_last_order <= {AT_RISK} THEN 'AT_RISK' ELSE 'CHURNED' END AS customer_status
  FROM a5d)"""

A6 = f"""a6 AS (
  SELECT payment_method, region, year, month, count(*) AS transaction_count, {tot_dec('sales_amount')} AS total_revenue,
         {mean('sales_amount')} AS avg_transaction_value
  FROM clean GROUP BY payment_method, region, year, month)"""

A7 = f"""a7 AS (
  SELECT status, region, year, month, count(*) AS order_count, {tot_dec('sales_amount')} AS revenue_at_risk
  FROM clean GROUP BY status, region, year, month)"""

A8 = f"""a8 AS (
  SELECT {tot_dec('sales_amount')} AS grand_total_revenue, {tot_dec('profit')} AS grand_total_profit,
         {r2("(CAST(sum(profit) AS DOUBLE) / nullif(count(profit), 0)) / nullif(CAST(sum(sales_amount) AS DOUBLE) / nullif(count(sales_amount), 0), 0) * 100")} AS overall_profit_margin_pct,
         CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT order_id) AS total_orders,
         count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products,
         {mean('sales_amount')} AS avg_order_value, min(order_date) AS data_from, max(order_date) AS data_to
  FROM clean)"""


def _replace(decimals: str) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in decimals.split()) + ")"


# --- stage 3 ---------------------------------------------------------------

def _mm(c: str) -> str:
    """Mean of stored 2-dp means from an exact sum."""
    return mean(f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,2))")


B2 = f"""b2 AS (
  SELECT region, country, {tot_dec('total_revenue')} AS total_revenue, {tot_dec('total_profit')} AS total_profit,
         CAST(sum(total_units_sold) AS BIGINT) AS total_units_sold, CAST(sum(total_orders) AS BIGINT) AS total_orders,
         {_mm('avg_order_value')} AS avg_order_value,
         {pct('sum(total_profit)', 'sum(total_revenue)')} AS profit_margin_pct
  FROM a1 GROUP BY region, country)"""

B3 = f"""b3 AS (
  SELECT category, sub_category, {tot_dec('total_revenue')} AS total_revenue, {tot_dec('total_profit')} AS total_profit,
         CAST(sum(total_units_sold) AS BIGINT) AS total_units_sold, CAST(sum(total_orders) AS BIGINT) AS total_orders,
         {_mm('avg_discount_pct')} AS avg_discount_pct,
         {pct('sum(total_profit)', 'sum(total_revenue)')} AS profit_margin_pct
  FROM a2 GROUP BY category, sub_category)"""

B5 = f"""b5 AS (
  SELECT customer_segment, customer_status, count(*) AS customer_count,
         {tot_dec('lifetime_value')} AS total_lifetime_value, {mean('lifetime_value')} AS avg_lifetime_value,
         {mean('total_orders')} AS avg_orders_per_customer
  FROM a5 GROUP BY customer_segment, customer_status)"""

B6 = """b6 AS (SELECT customer_segment, count(*) AS count FROM a5 GROUP BY customer_segment)"""

B7 = f"""b7 AS (
  SELECT payment_method, region, CAST(sum(transaction_count) AS BIGINT) AS transaction_count,
         {tot_dec('total_revenue')} AS total_revenue, {_mm('avg_transaction_value')} AS avg_transaction_value
  FROM a6 GROUP BY payment_method, region)"""

B8 = f"""b8 AS (
  SELECT status, region, CAST(sum(order_count) AS BIGINT) AS order_count, {tot_dec('revenue_at_risk')} AS total_revenue
  FROM a7 GROUP BY status, region)"""


def _with(select: str, *ctes: str) -> str:
    return with_base(select, ",\n".join(ctes))


_DT = "CASE WHEN l_suppkey % 2 = 0 THEN DATE '2001-08-01' ELSE DATE '2001-08-02' END"
_AUDIT = f"'{JOB}' AS etl_job, TIMESTAMP '{_RUN_TS}' AS etl_processed_at"
_COUNTS = ("(SELECT count(*) FROM b2)", "(SELECT count(*) FROM b3)", "(SELECT count(*) FROM a3)",
           "(SELECT count(*) FROM a4)", "(SELECT count(*) FROM b5)", "(SELECT count(*) FROM b7)",
           "(SELECT count(*) FROM b8)")
_COUNT_NAMES = ("regional_rows", "category_rows", "monthly_trend_rows", "top_product_rows", "customer_rows",
                "payment_rows", "status_rows")
_SECTIONS = ("regional_summary", "category_summary", "monthly_trends", "top_products", "customer_segments",
             "payment_distribution", "order_status_summary")
_ALL_KPI = (A1, A2, A3, A4, A5, A6, A7, B2, B3, B5, B7, B8)



def _u(field: str, key: str = "CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)") -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', '42', '{field}', {key})), 1, 13)) AS BIGINT) / 4503599627370496::DOUBLE"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in values) + "]"


def _choose(field: str, values: str, n: str) -> str:
    return f"({values})[1 + CAST(floor({_u(field)} * {n}) AS BIGINT)]"


def _weights(field: str, values, weights, kind: str) -> str:
    total, acc, out = float(sum(weights)), 0.0, "CASE"
    for v, w in zip(values, weights):
        acc += w / total
        out += f" WHEN {_u(field)} < {acc!r}::DOUBLE THEN {v!r}::{kind}"
    return f"{out} ELSE {values[-1]!r}::{kind} END"


_PRODUCTS = [(c, s, n, p) for c, subs in G.CATEGORIES.items() for s, ps in subs.items() for n, p in ps]
_SUBS = {c: list(subs) for c, subs in G.CATEGORIES.items()}
_PER_SUB = 5
SYNTH = f"""
s1 AS (
  SELECT l_orderkey, l_linenumber, {_choose('region', _list(G.REGIONS), str(len(G.REGIONS)))} AS region,
         {_choose('category', _list(G.CATEGORIES), str(len(G.CATEGORIES)))} AS category
  FROM lineitem),
s2 AS (
  SELECT *, CASE region {' '.join(f"WHEN '{r}' THEN {_choose('country', _list(cs), str(len(cs)))}" for r, cs in G.REGIONS.items())} END AS country,
         CASE category {' '.join(f"WHEN '{c}' THEN {_choose('sub', _list(ss), str(len(ss)))}" for c, ss in _SUBS.items())} END AS sub_category
  FROM s1),
products AS (SELECT *, (row_number() OVER (PARTITION BY sub ORDER BY place)) - 1 AS nth FROM (VALUES
  {', '.join(f"({k}, '{s}', '{n}', {p})" for k, (_, s, n, p) in enumerate(_PRODUCTS))}) AS t(place, sub, name, price)),
s3 AS (
  SELECT s2.*, name, {r2(f"price * ({1 - G.PRICE_SPREAD!r}::DOUBLE + {_u('price')} * {2 * G.PRICE_SPREAD!r}::DOUBLE)")} AS unit_price,
         {_weights('quantity', G.QUANTITIES, G.QUANTITY_WEIGHTS, 'INTEGER')} AS quantity,
         {_weights('discount', G.DISCOUNTS, G.DISCOUNT_WEIGHTS, 'DOUBLE')} AS discount,
         DATE '{G.START_DATE}' + CAST(floor({_u('date')} * (DATE '{G.END_DATE}' - DATE '{G.START_DATE}' + 1)) AS INTEGER) AS order_date
  FROM s2 JOIN products ON sub = sub_category AND nth = CAST(floor({_u('product')} * {_PER_SUB}) AS BIGINT)),
s4 AS (SELECT *, {r2("quantity * unit_price * (1 - discount)")} AS sales FROM s3),
synth AS (
  SELECT 'ORD-' || upper(substr(sha256(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 12)) AS order_id,
         printf('CUST-%05d', CAST(floor({_u('customer')} * 99000) + 1000 AS INTEGER)) AS customer_id,
         printf('PROD-%04d', CAST(('0x' || substr(md5(name), 1, 8)) AS BIGINT) % 10000) AS product_id,
         name AS product_name, category, sub_category, region, country, strftime(order_date, '%Y-%m-%d') AS order_date,
         strftime(order_date + CAST(floor({_u('ship_days')} * 7) AS INTEGER) + 1, '%Y-%m-%d') AS ship_date,
         CAST(quantity AS VARCHAR) AS quantity, CAST(unit_price AS VARCHAR) AS unit_price, CAST(discount AS VARCHAR) AS discount,
         CAST(sales AS VARCHAR) AS sales_amount,
         CAST({r2(f"sales * ({G.MARGIN_MIN!r}::DOUBLE + {_u('margin')} * {G.MARGIN_MAX - G.MARGIN_MIN!r}::DOUBLE)")} AS VARCHAR) AS profit,
         CAST({r2(f"CASE WHEN sales < {G.SHIPPING_BELOW} THEN {_u('ship_cost')} * {G.SHIPPING_MAX} ELSE 0::DOUBLE END")} AS VARCHAR) AS shipping_cost,
         {_choose('payment', _list(G.PAYMENT_METHODS), str(len(G.PAYMENT_METHODS)))} AS payment_method,
         {_choose('status', _list(G.ORDER_STATUSES), str(len(G.ORDER_STATUSES)))} AS status
  FROM s4),
dirt AS (
  SELECT * EXCLUDE (kind) REPLACE (
    CASE WHEN kind = 0 THEN '' ELSE 'ORD-' || upper(substr(sha256(concat_ws('|', 'dirt', order_id)), 1, 12)) END AS order_id,
    CASE WHEN kind = 1 THEN '  ' ELSE customer_id END AS customer_id, CASE WHEN kind = 2 THEN '-5' ELSE quantity END AS quantity,
    CASE WHEN kind = 3 THEN 'abc' ELSE unit_price END AS unit_price, CASE WHEN kind = 4 THEN 'not-a-date' ELSE order_date END AS order_date)
  FROM (SELECT *, CAST(floor({_u('dirt_kind', 'order_id')} * 5) AS INTEGER) AS kind FROM synth WHERE {_u('dirt', 'order_id')} < 0.02::DOUBLE))"""


def _schema_drift() -> str:
    """What type inference must make of the raw text, judged in SQL: a column is DOUBLE if each value reads as one."""
    fields = [(c, "string") for c in RAW_COLUMNS] + [("l_linenumber", "int"), ("l_suppkey", "bigint")]
    parts = []
    for k, (c, expected) in enumerate(fields):
        t = f"regexp_replace(nullif(trim(CAST({c} AS VARCHAR)), ''), '[dDfF]$', '')"
        parts.append(f"SELECT '{c}' AS \"column\", '{expected}' AS expected_type, {k} AS position, CASE "
                     f"WHEN bool_and(TRY_CAST({t} AS INTEGER) IS NOT NULL AND {t} NOT LIKE '%.%' AND {t} NOT LIKE '%e%') FILTER ({t} IS NOT NULL) THEN 'int' "
                     f"WHEN bool_and(TRY_CAST({t} AS DOUBLE) IS NOT NULL) FILTER ({t} IS NOT NULL) THEN 'double' "
                     f"ELSE 'string' END AS inferred_type FROM raw")
    return with_base("SELECT *, CASE WHEN expected_type = inferred_type THEN 'unchanged' ELSE 'type_changed' END AS change FROM ("
                     + " UNION ALL ".join(parts) + ")")


#: The columns of the catalog query's two headers, their types in the first and over both, and whether the second has them.
_CATALOG = (("order_id", "string", "string", True), ("quantity", "int", "double", True), ("l_linenumber", "int", "int", True),
            ("region", "string", "string", False), ("discount", "double", "double", True), ("dt", "date", "date", True),
            ("status", None, "string", True))


def _catalog_changes() -> str:
    rows = []
    for k, (c, old, new, stays) in enumerate(_CATALOG):
        known = "NULL" if old is None else f"'{old}'"
        if old:
            rows.append(f"('run-0', '{c}', 'created', NULL, {known}, {k}, '{new}', {stays})")
        if old != new:
            rows.append(f"('run-1', '{c}', '{'widened' if old else 'added'}', {known}, '{new}', {k}, '{new}', {stays})")
        if not stays:
            rows.append(f"('run-2', '{c}', 'removed', '{new}', '{new}', {k}, '{new}', {stays})")
    return (f"SELECT run_id, \"column\", change, old_type, new_type, CAST(position AS INTEGER) AS position, registered_type, "
            f"CASE WHEN stays THEN n ELSE 0 END AS filled FROM (VALUES {', '.join(rows)}) "
            f"v(run_id, \"column\", change, old_type, new_type, position, registered_type, stays), "
            f"(SELECT count(*) AS n FROM lineitem WHERE l_suppkey % 2 <> 0)")


def _table_versions() -> str:
    one = ("SELECT {n} AS version, count(*) AS counted_rows, count(*) FILTER (d IS NULL) AS counted_undated, count(*) AS read_rows, "
           "count(*) FILTER (d IS NULL) AS read_undated FROM (SELECT max(order_date) AS d FROM tagged "
           "WHERE quality = 'ok' AND {where} GROUP BY order_id, product_id)")
    return with_base(one.format(n=1, where="l_suppkey % 2 = 0") + " UNION ALL " + one.format(n=2, where="TRUE"))


def _incremental_kpis() -> str:
    def one(name: str, table: str, names: str, amount: str, count: str, figure: str = "NULL", dated: bool = True) -> str:
        text = "concat_ws('|', " + ", ".join(f"coalesce({c}, '-')" for c in names.split()) + ")"
        period = "year, month" if dated else "CAST(NULL AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month"
        return (f"SELECT '{name}' AS dataset, {text} AS names, {period}, CAST({amount} AS DOUBLE) AS amount, "
                f"CAST({count} AS BIGINT) AS n, CAST({figure} AS DOUBLE) AS figure FROM {table}")
    return _with(" UNION ALL ".join((
        one("region_country_monthly", "a1", "region country", "total_revenue", "total_orders", "profit_margin_pct"),
        one("category_monthly", "a2", "category sub_category", "total_revenue", "total_orders", "avg_discount_pct"),
        one("monthly_trend", "a3", "region", "monthly_revenue", "monthly_orders", "mom_growth_pct"),
        one("top_products_by_region", "a4", "region product_id", "total_revenue", "rank_in_region", "avg_unit_price", dated=False),
        one("customer_segments", "a5", "customer_id region country customer_segment customer_status", "lifetime_value",
            "total_orders", "avg_order_value", dated=False),
        one("payment_distribution", "a6", "payment_method region", "total_revenue", "transaction_count", "avg_transaction_value"),
        one("order_status_summary", "a7", "status region", "revenue_at_risk", "order_count"))), A1, A2, A3, A4, A5, A6, A7)


def _malformed_records() -> str:
    classes = ("malformed_record", "missing_required_field", "invalid_numeric", "unparseable_numeric", "unrepresentable_amount")
    counts = ", ".join(f"count(*) FILTER (WHERE q = '{c}') AS {c}" for c in classes)
    return with_base(f"""
SELECT c.*, c.malformed_record AS traceable, k.*, c.valid_rows - k.clean_rows AS duplicates_dropped
FROM (SELECT count(*) AS raw_rows, {counts}, count(*) FILTER (WHERE q = 'ok') AS valid_rows FROM m) c,
     (SELECT count(*) AS clean_rows, count(*) FILTER (WHERE d IS NULL) AS undated_rows
      FROM (SELECT max(order_date) AS d FROM m WHERE q = 'ok' GROUP BY order_id, product_id)) k""", """
m AS (SELECT *, CASE WHEN (l_suppkey * 3 + l_linenumber) % 40 < 3 THEN 'malformed_record' ELSE quality END AS q FROM tagged)""")


def _array(section: str, table: str, labels: str, amount: str, n: str, order: str, part: str = "") -> str:
    label = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in labels.split())
    return (f"SELECT '{section}' AS section, row_number() OVER ({part} ORDER BY {order}) - 1 AS position, "
            f"concat_ws('|', {label}) AS label, CAST({amount} AS DOUBLE) AS amount, CAST({n} AS BIGINT) AS n FROM {table}")


ORACLE: dict[str, str] = {
    "trim_blank_to_null": with_base(f"SELECT * FROM std"),
    "cast_numeric": with_base(
        "SELECT " + ", ".join(
            f"CAST({_TYPED[c]} AS DOUBLE) AS {c}" if c in _TYPED and c != "quantity" else
            (f"{_TYPED[c]} AS {c}" if c in _TYPED else c) for c in RAW_COLUMNS) + ", l_linenumber, l_suppkey FROM std"),
    "parse_dates": with_base(
        "SELECT " + ", ".join(f"{_DATES[c]} AS {c}" if c in _DATES else c for c in RAW_COLUMNS)
        + ", l_linenumber, l_suppkey FROM std"),
    "quality_tags": with_base(f"SELECT {_TAGGED_EDGE} FROM tagged"),
    "sales_reconciliation": with_base(
        "SELECT order_id, product_id, l_linenumber, l_suppkey, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(discount AS DOUBLE) AS discount, CAST(sales_amount AS DOUBLE) AS sales_amount, "
        "CAST(sales_amount_calc AS DOUBLE) AS sales_amount_calc, sales_amount_flag FROM tagged"),
    "valid_required": with_base(f"SELECT * FROM std WHERE {_REQ}"),
    "quarantine_missing": _quarantine("quality = 'missing_required_field'"),
    "quarantine_invalid": _quarantine("quality = 'invalid_numeric'"),
    "quarantine_unparseable": _quarantine("quality = 'unparseable_numeric'"),
    "valid_numeric": with_base(f"SELECT {_CLEAN_EDGE} FROM tagged WHERE quality = 'ok'"),
    "quarantine_all": _quarantine(),
    "dedup_latest": with_base(f"SELECT {_CLEAN_EDGE} FROM clean"),
    "period_columns": with_base("SELECT order_id, product_id, order_date, year, month FROM clean"),
    "undated_rows": with_base(f"SELECT {_CLEAN_EDGE}, year, month FROM clean WHERE order_date IS NULL"),
    "distinct_regions": with_base("SELECT DISTINCT region FROM clean"),
    "reconciliation_summary": with_base(
        "SELECT sales_amount_flag, count(*) AS row_count FROM clean GROUP BY sales_amount_flag"),
    "run_metrics": with_base("""
SELECT t.raw_rows, t.malformed_record, t.missing_required_field, t.invalid_numeric, t.unparseable_numeric, t.unrepresentable_amount, t.valid_rows,
       c.clean_rows, c.undated_rows, t.valid_rows - c.clean_rows AS duplicates_dropped
FROM (SELECT count(*) AS raw_rows,
             count(*) FILTER (WHERE quality = 'malformed_record') AS malformed_record,
             count(*) FILTER (WHERE quality = 'missing_required_field') AS missing_required_field,
             count(*) FILTER (WHERE quality = 'invalid_numeric') AS invalid_numeric,
             count(*) FILTER (WHERE quality = 'unparseable_numeric') AS unparseable_numeric,
             count(*) FILTER (WHERE quality = 'unrepresentable_amount') AS unrepresentable_amount,
             count(*) FILTER (WHERE quality = 'ok') AS valid_rows FROM tagged) t,
     (SELECT count(*) AS clean_rows, count(*) FILTER (WHERE order_date IS NULL) AS undated_rows FROM clean) c"""),
    # stage 2
    "region_country_monthly": _with(f"SELECT {_replace('total_revenue total_profit')} FROM a1", A1),
    "category_monthly": _with(f"SELECT {_replace('total_revenue total_profit')} FROM a2", A2),
    "monthly_trend": _with(f"SELECT {_replace('monthly_revenue monthly_profit')} FROM a3", A3),
    "mom_growth_calendar": _with(f"""
SELECT {_replace('monthly_revenue monthly_profit').replace('* REPLACE', '* EXCLUDE (prev, pidx) REPLACE')},
       {_growth('monthly_revenue', 'CASE WHEN pidx = year * 12 + month - 1 THEN prev END')} AS mom_growth_pct
FROM (SELECT *, lag(monthly_revenue) OVER w AS prev, lag(year * 12 + month) OVER w AS pidx
      FROM a3b WHERE year IS NOT NULL AND month IS NOT NULL
      WINDOW w AS (PARTITION BY region ORDER BY year ASC NULLS FIRST, month ASC NULLS FIRST))""", A3_BASE),
    "mom_growth": with_base(f"""
SELECT region, country, year, month, CAST(revenue AS DOUBLE) AS revenue, {_growth('revenue', 'prev')} AS mom_growth_pct
FROM (SELECT *, lag(revenue) OVER (PARTITION BY region, country ORDER BY year ASC NULLS FIRST, month ASC NULLS FIRST) AS prev
      FROM (SELECT region, country, year, month, {tot_dec('sales_amount')} AS revenue FROM clean GROUP BY ALL))"""),
    "product_region_totals": _with(f"SELECT {_replace('total_revenue total_profit')} FROM a4b", A4B),
    "top_products_by_region": _with(f"SELECT {_replace('total_revenue total_profit')} FROM a4", A4),
    "top_products_row_number": _with("""
SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit) FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY total_revenue DESC NULLS LAST,
      product_id ASC NULLS FIRST, product_name ASC NULLS FIRST, category ASC NULLS FIRST, sub_category ASC NULLS FIRST,
      total_revenue ASC NULLS FIRST, total_profit ASC NULLS FIRST, total_units_sold ASC NULLS FIRST,
      total_orders ASC NULLS FIRST, avg_unit_price ASC NULLS FIRST) AS INTEGER) AS rank_in_region
  FROM a4b)
WHERE rank_in_region <= 10""", A4B),
    "top_n_per_group": with_base(f"""
SELECT country, customer_id, CAST(revenue AS DOUBLE) AS revenue, rank FROM (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY country ORDER BY revenue DESC NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT country, customer_id, {tot_dec('sales_amount')} AS revenue FROM clean GROUP BY country, customer_id))
WHERE rank <= 5"""),
    "customer_segments": _with(
        f"SELECT {_replace('lifetime_value total_profit_generated')} FROM a5", A5),
    "payment_distribution": _with(f"SELECT {_replace('total_revenue')} FROM a6", A6),
    "order_status_summary": _with(f"SELECT {_replace('revenue_at_risk')} FROM a7", A7),
    "overall_kpi": _with(f"SELECT {_replace('grand_total_revenue grand_total_profit')} FROM a8", A8),
    "regional_grouping_sets": with_base(f"""
SELECT region, country, year, month, CAST(grouping(region, country, year, month) AS BIGINT) AS grain,
       {tot('sales_amount')} AS total_revenue, {tot('profit')} AS total_profit,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT order_id) AS total_orders,
       {mean('sales_amount')} AS avg_order_value, {pct('sum(profit)', 'sum(sales_amount)')} AS profit_margin_pct,
       {r2("CAST(sum(sales_amount) AS DOUBLE) / nullif(CAST(count(DISTINCT order_id) AS DOUBLE), 0)")} AS revenue_per_order
FROM clean GROUP BY GROUPING SETS ((region, country, year, month), (region, country), (region), ())"""),
    "category_rollup": with_base(f"""
SELECT category, sub_category, CAST(grouping(category, sub_category) AS BIGINT) AS grain,
       {tot('sales_amount')} AS total_revenue, {tot('profit')} AS total_profit,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT order_id) AS total_orders,
       {r2("CAST(sum(discount) AS DOUBLE) / nullif(count(discount), 0) * 100")} AS avg_discount_pct,
       {pct('sum(profit)', 'sum(sales_amount)')} AS profit_margin_pct,
       {r2("CAST(sum(sales_amount) AS DOUBLE) / nullif(CAST(count(DISTINCT order_id) AS DOUBLE), 0)")} AS revenue_per_order
FROM clean GROUP BY ROLLUP (category, sub_category)"""),
    "order_sketches": with_base(
        "SELECT region, year, month, count(DISTINCT order_id) AS total_orders, TRUE AS sketch_within_bound "
        "FROM clean GROUP BY region, year, month"),
    "sketch_merge": with_base(
        "SELECT region, count(DISTINCT order_id) AS total_orders, TRUE AS merged_within_bound FROM clean GROUP BY region"),
    # stage 3
    "regional_summary": _with(f"SELECT {_replace('total_revenue total_profit')} FROM b2", A1, B2),
    "category_summary": _with(f"SELECT {_replace('total_revenue total_profit')} FROM b3", A2, B3),
    "monthly_trends": _with(f"SELECT {_replace('monthly_revenue monthly_profit')}, CAST(row_number() OVER (ORDER BY "
                            "year ASC NULLS FIRST, month ASC NULLS FIRST, region ASC NULLS FIRST) AS INTEGER) AS position FROM a3", A3),
    "segment_status_summary": _with(f"SELECT {_replace('total_lifetime_value')} FROM b5", A5, B5),
    "segment_totals": _with("SELECT * FROM b6", A5, B6),
    "payment_summary": _with(f"SELECT {_replace('total_revenue')} FROM b7", A6, B7),
    "status_summary": _with(f"SELECT {_replace('total_revenue')} FROM b8", A7, B8),
    "record_counts": _with("""
SELECT (SELECT count(*) FROM b2) AS regional_rows, (SELECT count(*) FROM b3) AS category_rows,
       (SELECT count(*) FROM a3) AS monthly_trend_rows, (SELECT count(*) FROM a4) AS top_product_rows,
       (SELECT count(*) FROM b5) AS customer_rows, (SELECT count(*) FROM b7) AS payment_rows,
       (SELECT count(*) FROM b8) AS status_rows""", A1, A2, A3, A4, A5, A6, A7, B2, B3, B5, B7, B8),
    # I/O, report, incremental
    "synth_sales": f"WITH {SYNTH} SELECT * FROM synth UNION ALL SELECT * FROM dirt",
    "synth_undated": f"WITH {SYNTH} SELECT count(DISTINCT (order_id, product_id)) AS undated_rows FROM dirt WHERE order_date = 'not-a-date'",
    "schema_drift": _schema_drift(),
    "catalog_changes": _catalog_changes(),
    "malformed_records": _malformed_records(),
    "table_versions": _table_versions(),
    "incremental_kpis": _incremental_kpis(),
    "incremental_overall": _with(f"SELECT {_replace('grand_total_revenue grand_total_profit')} FROM a8", A8),
    "month_filters": with_base("SELECT year, month, count(*) AS found, TRUE AS few_others FROM clean GROUP BY year, month"),
    "report_arrays": _with(" UNION ALL ".join((
        _array("regional_summary", "b2", "region country", "total_revenue", "total_orders", "total_revenue DESC NULLS LAST"),
        _array("category_summary", "b3", "category sub_category", "total_revenue", "total_orders",
               "category ASC NULLS FIRST, total_revenue DESC NULLS LAST"),
        _array("monthly_trends", "a3", "year month region", "monthly_revenue", "monthly_orders",
               "year ASC NULLS FIRST, month ASC NULLS FIRST, region ASC NULLS FIRST"),
        _array("customer_segments", "b5", "customer_segment customer_status", "total_lifetime_value", "customer_count",
               "customer_segment ASC NULLS FIRST, customer_status ASC NULLS FIRST"),
        _array("payment_distribution", "b7", "region payment_method", "total_revenue", "transaction_count",
               "region ASC NULLS FIRST, total_revenue DESC NULLS LAST"),
        _array("order_status_summary", "b8", "region status", "total_revenue", "order_count",
               "region ASC NULLS FIRST, status ASC NULLS FIRST"),
        _array("top_products", "a4", "region rank_in_region product_id", "total_revenue", "total_orders",
               "rank_in_region", "PARTITION BY region"))), *_ALL_KPI),
    "report_file": f"SELECT '{RUN_ID}' AS run_id, TRUE AS report_is_file, TRUE AS manifest_is_file, TRUE AS size_matches",
    "verify_report": _with(
        f"SELECT '{RUN_ID}' AS run_id, 'SUCCESS' AS status, TRUE AS counts_match, TRUE AS size_matches, "
        + ", ".join(f"CAST({c} AS BIGINT) AS {n}" for c, n in zip(_COUNTS, _COUNT_NAMES)), *_ALL_KPI),
    "quarantine_sink": _quarantine().replace("SELECT order_id, quality AS", f"SELECT '{RUN_ID}' AS run_id, order_id, quality AS"),
    "kpi_sink": _with(f"SELECT {_replace('total_revenue total_profit')}, '{JOB}' AS etl_job, TIMESTAMP '{_RUN_TS}' AS etl_ts FROM a1", A1),
    "audit_dropped": _with(f"SELECT {_replace('total_revenue total_profit')} FROM a1", A1),
    "raw_scan": with_base(f"SELECT *, {_DT} AS dt FROM std"),
    "cleaned_scan": with_base(f"SELECT {_CLEAN_EDGE}, year, month FROM clean"),
    "stream_ingest": with_base(f"SELECT {_CLEAN_EDGE}, year, month, {_DT} AS dt, {_AUDIT} FROM clean"),
    "reuploaded_files": with_base(f"SELECT {_CLEAN_EDGE}, year, month, {_DT} AS dt, {_AUDIT} FROM clean"),
    "file_ledger": with_base(f"SELECT strftime({_DT}, '%Y-%m-%d') AS dt, count(*) AS rows, count(*) FILTER ({_QUALITY} <> 'ok') AS rejected, "
                             "CAST(0 AS BIGINT) AS open_files FROM std GROUP BY 1"),
    "top_products_nested": _with("""
SELECT coalesce(region, 'UNKNOWN') AS region, count(*) AS product_count,
       min(product_id) FILTER (WHERE rank_in_region = 1) AS first_product
FROM a4 GROUP BY 1""", A4),
    "report_sections": _with(" UNION ALL ".join(
        f"SELECT '{s}' AS section, CAST({c} AS BIGINT) AS rows" for s, c in zip(_SECTIONS, _COUNTS)), *_ALL_KPI),
    "report_json_values": _with("""
SELECT CAST(grand_total_revenue AS DOUBLE) AS grand_total_revenue, CAST(grand_total_profit AS DOUBLE) AS grand_total_profit,
       overall_profit_margin_pct, total_units_sold, total_orders, unique_customers, unique_products, avg_order_value,
       strftime(data_from, '%Y-%m-%dT%H:%M:%S') AS data_from, strftime(data_to, '%Y-%m-%dT%H:%M:%S') AS data_to,
       strftime(data_from, '%Y-%m-%dT%H:%M:%S') AS range_from, strftime(data_to, '%Y-%m-%dT%H:%M:%S') AS range_to,
       (SELECT count(*) FROM a5 WHERE customer_segment = 'HIGH_VALUE') AS high_value_customers,
       (SELECT count(DISTINCT coalesce(region, 'UNKNOWN')) FROM a4) AS top_product_regions
FROM a8""", A8, A5, A4),
    "manifest": _with(
        f"SELECT '{RUN_ID}' AS run_id, '{RUN_TS.isoformat()}' AS generated_at, "
        "'consolidated/2001/08/01/etl_report_fixture-run.json' AS output_path, 'SUCCESS' AS status, "
        + ", ".join(f"CAST({c} AS INTEGER) AS {n}" for c, n in zip(_COUNTS, _COUNT_NAMES)), *_ALL_KPI),
}
