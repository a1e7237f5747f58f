"""Report assembly: shape, ordering, NULL keys, JSON fidelity."""

import datetime as dt
import json
import os

from helpers import raw_df, row
from salesmart.operators import clean as C
from salesmart.operators import kpis as K
from salesmart.operators import report as R
from salesmart.operators import summary as B
from salesmart.sinks import write_json_text


def sections_of(c):
    a5 = K.customer_segments(c, as_of="2024-06-01")
    return {
        "overall_kpi": K.overall_kpi(c),
        "regional_summary": B.regional_summary(K.region_country_monthly(c)),
        "category_summary": B.category_summary(K.category_monthly(c)),
        "monthly_trends": K.monthly_trend(c),
        "top_products": K.top_products_by_region(c),
        "customer_segments": B.segment_status_summary(a5),
        "segment_totals": B.segment_totals(a5),
        "payment_distribution": B.payment_summary(K.payment_distribution(c)),
        "order_status_summary": B.status_summary(K.order_status_summary(c)),
    }


def build(spark, *rows):
    c = C.clean(raw_df(spark, *rows))
    return R.build_report(sections_of(c), "run-1", dt.datetime(2024, 6, 1, 2, 0, 0), "job")


def test_report_shape_order_and_null_region(spark):
    rows = [row(order_id="A", region="EU", country="DE", sales_amount="10.00"),
            row(order_id="B", region="EU", country="FR", sales_amount="30.00"),
            row(order_id="C", region=None, country="XX", sales_amount="5.00", order_date="2024-02-01")]
    doc = json.loads(R.report_json(build(spark, *rows)).collect()[0]["json"])
    assert list(doc) == ["metadata", "overall_kpi", "regional_summary", "category_summary", "monthly_trends",
                         "top_products", "customer_segments", "payment_distribution", "order_status_summary"]
    assert [r["country"] for r in doc["regional_summary"]] == ["FR", "DE", "XX"]     # revenue desc
    assert set(doc["top_products"]) == {"EU", "UNKNOWN"}
    assert doc["metadata"]["record_counts"]["top_product_rows"] == 2
    assert doc["metadata"]["data_range"] == {"from": "2024-01-15T00:00:00", "to": "2024-02-01T00:00:00"}
    assert doc["metadata"]["generated_at"] == "2024-06-01T02:00:00"
    assert doc["metadata"]["customer_segment_totals"] == {"LOW_VALUE": 3}
    # NULL fields are kept (region of the unknown row)
    assert any(r["region"] is None for r in doc["regional_summary"])
    m = [(t["year"], t["month"]) for t in doc["monthly_trends"]]
    assert m == sorted(m)


def test_empty_report_is_valid(spark):
    doc = json.loads(R.report_json(build(spark, row(order_id=""))).collect()[0]["json"])
    assert doc["regional_summary"] == [] and doc["top_products"] == {}
    assert doc["overall_kpi"]["grand_total_revenue"] is None and doc["overall_kpi"]["total_orders"] == 0
    assert set(doc["metadata"]["record_counts"].values()) == {0}


def test_manifest_matches_report(spark, tmp_dir):
    rep = build(spark, row())
    path = f"{tmp_dir}/x.json"
    size = write_json_text(R.report_json(rep), path)
    write_json_text(R.report_json(rep), path)       # a rerun replaces the file
    m = R.manifest(rep, "run-1", dt.datetime(2024, 6, 1), path, size).collect()[0]
    assert m["file_size_bytes"] == os.path.getsize(path) and m["status"] == "SUCCESS"
    assert json.load(open(path))["metadata"]["run_id"] == "run-1"
    assert [n for n in os.listdir(tmp_dir) if not n.endswith(".crc")] == ["x.json"]
    assert m["record_counts"]["regional_rows"] == 1
