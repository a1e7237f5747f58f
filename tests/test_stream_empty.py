"""A month whose only row moves to another month is emptied, not left stale."""

from helpers import raw_df, row
from salesmart.operators.clean import QUALITY, tag_quality
from salesmart.sources.parquet import read_cleaned
from salesmart.streaming import merge_latest


def ok_rows(spark, *rows):
    return tag_quality(raw_df(spark, *rows)).filter(f"{QUALITY} = 'ok'").drop(QUALITY)


def test_moved_row_leaves_no_stale_version(spark, tmp_dir):
    out = f"{tmp_dir}/cleaned"
    merge_latest(spark, ok_rows(spark, row(order_date="2024-01-15"), row(order_id="ORD-2")), out, f"{tmp_dir}/s0")
    merge_latest(spark, ok_rows(spark, row(order_date="2024-03-15")), out, f"{tmp_dir}/s1")
    got = sorted((r["order_id"], r["month"]) for r in read_cleaned(spark, out).collect())
    assert got == [("ORD-1", 3), ("ORD-2", 1)]
    merge_latest(spark, ok_rows(spark, row(order_id="ORD-2", order_date="2024-05-01")), out, f"{tmp_dir}/s2")
    got = sorted((r["order_id"], r["month"]) for r in read_cleaned(spark, out).collect())
    assert got == [("ORD-1", 3), ("ORD-2", 5)]    # January is now empty
