"""Stage 1 in one scan, with malformed lines as a class and counters of what was committed."""
import os

import pytest

from helpers import raw_df, row
from salesmart.operators.clean import tag_quality
from salesmart.operators.quality import QUALITY_CLASSES
from salesmart.plans.jobs import Run, run_clean
from salesmart.schema import RAW_COLUMNS, RAW_SCHEMA
from salesmart.sinks.files import Files
from salesmart.sources.csv import read_raw_sales

GOOD = "ORD-{},CUST-1,PROD-1,Desk,Home,Desks,North,DE,2024-01-05,2024-01-07,2,10.00,0,20.00,5.00,0,Card,Delivered"


def lines(tmp_dir, *rows):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write("\n".join([",".join(RAW_COLUMNS), *rows]) + "\n")
    return f"{tmp_dir}/in"


BAD = [GOOD.format(2).rsplit(",", 1)[0], GOOD.format(3) + ",more", GOOD.format(4).replace("Desk,", '"Desk,', 1), "lone", ' , "']
FINE = [GOOD.format(1), GOOD.format(5).replace("Desk,", '"a ""b"", c",', 1), GOOD.format(6).replace("Delivered", '"Delivered'),
        GOOD.format(7).replace("Card", ""), GOOD.format(1)]


def test_malformed_lines(spark, tmp_dir):
    path = lines(tmp_dir, *FINE, *BAD)
    m = run_clean(spark, path, f"{tmp_dir}/cleaned", f"{tmp_dir}/q", Run(), malformed=True)
    assert m == {"raw_rows": 10, "malformed_record": 5, "missing_required_field": 0, "invalid_numeric": 0, "unparseable_numeric": 0,
                 "unrepresentable_amount": 0, "valid_rows": 5, "clean_rows": 4, "undated_rows": 0, "duplicates_dropped": 1}
    q = spark.read.parquet(f"{tmp_dir}/q").collect()
    assert sorted(r.malformed_record for r in q) == sorted(BAD) and all(r.source_file.endswith("/a.csv") for r in q)
    cleaned = spark.read.parquet(f"{tmp_dir}/cleaned")
    assert {r.order_id: r.product_name for r in cleaned.collect()} == {"ORD-1": "Desk", "ORD-5": 'a "b", c', "ORD-6": "Desk", "ORD-7": "Desk"}
    assert "malformed_record" not in cleaned.columns and "source_file" not in cleaned.columns


def test_pruned_columns_change_no_class(spark, tmp_dir):
    """Without the option's effect, a scan of two columns would parse those alone and find no line malformed."""
    tagged = tag_quality(read_raw_sales(spark, lines(tmp_dir, *FINE, *BAD), malformed=True))
    assert {r.quality: r["count"] for r in tagged.select("quality").groupBy("quality").count().collect()} == {"ok": 5, "malformed_record": 5}


def test_without_the_option_lines_are_read_as_before(spark, tmp_dir):
    m = run_clean(spark, lines(tmp_dir, *FINE, *BAD), f"{tmp_dir}/cleaned", f"{tmp_dir}/q", Run())
    assert m["malformed_record"] == 0 and m["valid_rows"] == 7 and m["raw_rows"] == 10


def test_raw_text_is_scanned_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    rows = raw_df(spark, *(row(order_id=f"ORD-{k % 50}" if k % 7 else "") for k in range(100)))
    m = run_clean(spark, "", f"{tmp_dir}/cleaned", f"{tmp_dir}/q", Run(), raw=rows.mapInPandas(count, RAW_SCHEMA))
    assert seen.value == 100 == m["raw_rows"] == sum(m[c if c != "ok" else "valid_rows"] for c in QUALITY_CLASSES)
    assert m["missing_required_field"] == 15 == spark.read.parquet(f"{tmp_dir}/q").count()
    assert m["clean_rows"] == spark.read.parquet(f"{tmp_dir}/cleaned").count() == m["valid_rows"] - m["duplicates_dropped"]


@pytest.mark.parametrize("rows", [[], [row(order_id="")], [row()]])
def test_classes_without_rows(spark, tmp_dir, rows):
    m = run_clean(spark, "", f"{tmp_dir}/cleaned", f"{tmp_dir}/q", Run(), raw=raw_df(spark, *rows) if rows else raw_df(spark, row()).filter("false"))
    assert m["raw_rows"] == len(rows) and m["clean_rows"] + m["missing_required_field"] == len(rows)


def test_scratch_is_left_clean(spark, tmp_dir):
    from salesmart.session import checkpoint_root
    run = Run(run_id="own-run")
    run_clean(spark, "", f"{tmp_dir}/cleaned", f"{tmp_dir}/q", run, raw=raw_df(spark, row()))
    assert not [n for n in Files(spark).names(f"{checkpoint_root(spark)}/salesmart") if "own-run" in n]
