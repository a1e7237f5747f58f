"""Stage-1 edge rows, quality classes, dedup determinism, ANSI and partition independence."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, row
from salesmart.operators import clean as C
from salesmart.sources.csv import read_raw_sales


def tag_of(spark, **kw):
    r = C.tag_quality(raw_df(spark, row(**kw))).collect()[0]
    return r


@pytest.mark.parametrize("kw,expected", [
    ({}, "ok"),
    ({"order_id": ""}, "missing_required_field"),
    ({"customer_id": "  "}, "missing_required_field"),
    ({"order_date": None}, "missing_required_field"),
    ({"quantity": "-5"}, "invalid_numeric"),
    ({"quantity": "0"}, "invalid_numeric"),
    ({"quantity": "-5", "unit_price": "abc"}, "invalid_numeric"),   # TRUE OR NULL
    ({"unit_price": "abc"}, "unparseable_numeric"),
    ({"unit_price": "NaN"}, "unparseable_numeric"),
    ({"unit_price": "1e400"}, "unparseable_numeric"),
    ({"quantity": "x", "unit_price": "-1"}, "invalid_numeric"),
    ({"order_date": "not-a-date"}, "ok"),                           # kept, undated
])
def test_quality_classes(spark, kw, expected):
    assert tag_of(spark, **kw)["quality"] == expected


def test_trim_is_spaces_only_and_blank_is_null(spark):
    r = tag_of(spark, order_id="\tORD-1", region="  EU  ", category="   ")
    assert r["order_id"] == "\tORD-1"
    assert r["region"] == "EU"
    assert r["category"] is None


def test_lenient_quantity_truncates(spark):
    assert tag_of(spark, quantity="2.5")["quantity"] == 2


@pytest.mark.parametrize("text,expected", [
    ("2024-02-29", dt.datetime(2024, 2, 29)),
    ("2023-02-29", None),
    ("03-04-2024", dt.datetime(2024, 4, 3)),       # dd-MM-yyyy wins over nothing else
    ("04/03/2024", dt.datetime(2024, 4, 3)),       # MM/dd/yyyy
    ("2024/04/03", dt.datetime(2024, 4, 3)),
    ("2024-1-5", None),                            # two-digit fields required
    ("2024-01-05 10:00", None),
    ("not-a-date", None),
])
def test_date_layouts(spark, text, expected):
    assert tag_of(spark, order_date=text)["order_date"] == expected


@pytest.mark.parametrize("kw,flag", [
    ({}, "OK"),
    ({"discount": "1.0", "sales_amount": "5.00"}, "OK"),                      # calc 0
    ({"quantity": "10", "unit_price": "10.00", "discount": "0", "sales_amount": "101.00"}, "OK"),   # exactly 1 %
    ({"quantity": "10", "unit_price": "10.00", "discount": "0", "sales_amount": "101.01"}, "MISMATCH"),
    ({"sales_amount": None}, "OK"),
    ({"discount": None, "sales_amount": "18.00"}, "MISMATCH"),              # NULL discount counts as 0
    ({"discount": "1.5", "sales_amount": "99"}, "OK"),                      # negative calc
])
def test_sales_flag(spark, kw, flag):
    assert tag_of(spark, **kw)["sales_amount_flag"] == flag


def test_dedup_keeps_latest_then_dated(spark):
    rows = [row(order_date="2024-01-15", quantity="1"), row(order_date="2024-02-15", quantity="2"),
            row(order_id="ORD-2", order_date="not-a-date", quantity="5"),
            row(order_id="ORD-2", order_date="2023-05-05", quantity="6")]
    out = {r["order_id"]: r for r in C.clean(raw_df(spark, *rows)).collect()}
    assert out["ORD-1"]["quantity"] == 2
    assert out["ORD-2"]["quantity"] == 6
    assert (out["ORD-1"]["year"], out["ORD-1"]["month"]) == (2024, 2)


def test_dedup_same_date_is_stable_over_partitioning(spark):
    rows = [row(quantity=str(q), sales_amount=f"{q * 9}.00") for q in (3, 1, 2)] * 3
    winners = set()
    for n in (1, 8, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = raw_df(spark, *rows).repartition(n)
        winners.add(tuple(C.clean(df).collect()[0]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(winners) == 1
    assert list(winners)[0][10] == 1   # quantity: smallest tie-break value wins


def test_quarantine_keeps_reason_and_raw_text(spark):
    ts = dt.datetime(2024, 1, 1)
    q = C.quarantine(raw_df(spark, row(), row(order_id=""), row(unit_price="abc")), ts).collect()
    assert sorted(r["quarantine_reason"] for r in q) == ["missing_required_field", "unparseable_numeric"]
    assert {r["unit_price"] for r in q} == {"10.00", "abc"}
    assert all(r["quarantine_ts"] == ts for r in q)
    assert C.quarantine(raw_df(spark, row()), ts, full=False).columns == ["order_id", "quarantine_reason", "quarantine_ts"]


def test_every_raw_row_is_accounted_for(spark):
    from conftest import SF_SMALL
    from salesmart.plans import queries as Q
    m = Q.QUERIES["run_metrics"](spark, SF_SMALL).collect()[0]
    assert m["raw_rows"] == (m["missing_required_field"] + m["invalid_numeric"] + m["unparseable_numeric"]
                             + m["unrepresentable_amount"] + m["valid_rows"])
    assert m["unrepresentable_amount"] > 0
    assert m["valid_rows"] == m["clean_rows"] + m["duplicates_dropped"]
    assert (m["raw_rows"], m["clean_rows"]) == (6000, 5670)   # FIXTURES.md §3 with buckets 15, 18, 19 and 20


@pytest.mark.parametrize("change, quality, stored, flag", [
    (dict(discount="100"), "ok", ("discount", 100), "OK"),                 # a negative amount is no mismatch
    (dict(discount="150"), "ok", ("discount", 150), "OK"),
    (dict(unit_price="0.00004"), "ok", ("unit_price", 0.00004), "OK"),
    (dict(unit_price="0.00000004", sales_amount="0"), "ok", ("unit_price", 0), "OK"),
    (dict(unit_price="1e15"), "ok", ("unit_price", 1e15), "MISMATCH"),
    (dict(sales_amount="1e15"), "ok", ("sales_amount", 1e15), "MISMATCH"),
    (dict(profit="-1e17"), "ok", ("profit", -1e17), "OK"),
    (dict(unit_price="5D"), "ok", ("unit_price", 5), "MISMATCH"),
    (dict(unit_price="1e18"), "unrepresentable_amount", ("unit_price", None), "OK"),
    (dict(sales_amount="-1e300"), "unrepresentable_amount", ("sales_amount", None), "OK"),
    (dict(sales_amount="NaN"), "ok", ("sales_amount", None), "OK"),
    (dict(quantity="1e2"), "unparseable_numeric", ("quantity", None), "OK"),
    (dict(quantity="5D"), "unparseable_numeric", ("quantity", None), "OK"),
    (dict(quantity="+7."), "ok", ("quantity", 7), "MISMATCH"),
])
def test_amounts_are_never_lost_silently(spark, change, quality, stored, flag):
    r = C.tag_quality(raw_df(spark, row(**change))).first()
    column, value = stored
    assert r["quality"] == quality and r["sales_amount_flag"] == flag
    assert (r[column] is None) if value is None else float(r[column]) == value


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cleaning_is_ansi_independent(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [row(), row(unit_price="abc"), row(quantity="2.5"), row(order_date="x"),
                row(unit_price="1e400"), row(discount="zz"), row(quantity="99999999999")]
        out = sorted(((r["quality"], r["quantity"]) for r in C.tag_quality(raw_df(spark, *rows)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert out == sorted([("ok", 2), ("unparseable_numeric", 2), ("ok", 2), ("ok", 2),
                          ("unparseable_numeric", 2), ("ok", 2), ("unparseable_numeric", None)], key=repr)


def test_csv_scan_edge_cases(spark, tmp_dir):
    header = "order_id,customer_id,product_id,product_name,category,sub_category,region,country,order_date,ship_date,quantity,unit_price,discount,sales_amount,profit,shipping_cost,payment_method,status"
    lines = [
        header,
        'ORD-1,CUST-1,PROD-1,"He said ""hi"", ok",C,S,EU,DE,2024-01-15,2024-01-17,2,10.00,0.1,18.00,3.00,1.00,Card,Delivered',
        "ORD-2,CUST-1,PROD-1,W,C,S,EU,DE,2024-01-15,2024-01-17,2,10.00,0.1,18.00,3.00,1.00,Card",                 # 17 fields
        "ORD-3,CUST-1,PROD-1,W,C,S,EU,DE,2024-01-15,2024-01-17,2,10.00,0.1,18.00,3.00,1.00,Card,Delivered,EXTRA",  # 19
    ]
    import os
    os.makedirs(f"{tmp_dir}/sales/dt=2024-01-16")
    with open(f"{tmp_dir}/sales/dt=2024-01-16/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/sales/dt=2024-01-16/notes.txt", "w") as f:
        f.write("ignored\n")
    df = read_raw_sales(spark, f"{tmp_dir}/sales")
    rows = {r["order_id"]: r for r in df.collect()}
    assert rows["ORD-1"]["product_name"] == 'He said "hi", ok'
    assert rows["ORD-2"]["status"] is None
    assert rows["ORD-3"]["status"] == "Delivered"
    assert str(rows["ORD-1"]["dt"]) == "2024-01-16"
    assert len(rows) == 3


def test_header_check_rejects_reordered_columns(spark, tmp_dir):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write("customer_id,order_id\nA,B\n")
    with pytest.raises(Exception):
        read_raw_sales(spark, tmp_dir, header_check=True).collect()
    assert read_raw_sales(spark, tmp_dir).collect()[0]["order_id"] == "A"   # positional by default


def test_fixture_totals_equal_blueprint(spark):
    """Rows, flags and totals of the cleaned fixture at sf0.001 (FIXTURES.md §4, with the buckets of §3a)."""
    from conftest import SF_SMALL
    from salesmart.plans import queries as Q
    c = Q.cleaned(spark, SF_SMALL)
    r = c.agg(F.count(F.lit(1)).alias("n"), F.count("order_date").alias("dated"),
              F.count_distinct("order_id").alias("orders"),
              F.count_if(F.col("sales_amount_flag") == "MISMATCH").alias("mismatch"),
              F.sum("sales_amount").alias("sales"), F.sum("profit").alias("profit"),
              F.sum("quantity").alias("qty")).collect()[0]
    assert (r["n"], r["dated"], r["orders"], r["mismatch"]) == (5670, 5616, 1463, 137)
    assert (str(r["sales"]), str(r["profit"]), r["qty"]) == ("41000000123352310.800000", "24627728.360000", 143456)


def test_filters_on_the_tag_stay_above_the_raw_text(spark):
    """Text that expressions made is made once a row: a filter on the tag isn't pushed below them, with a copy at every use."""
    made = raw_df(spark, row(), row(order_id="")).withColumn("quantity", F.concat(F.lit("made-here"), "quantity"))
    for df in (C.valid_rows(C.tag_quality(made)), C.rejected(C.with_quality(made))):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("made-here") == 1
