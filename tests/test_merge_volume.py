"""What a merge into the cleaned table doesn't shuffle or hold: whole rows."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, row
from salesmart.operators.clean import QUALITY, tag_quality
from salesmart.operators.windows import dedup_latest
from salesmart.plans import io_queries as IO
from salesmart.sinks.versions import VersionedTable
from salesmart.sources.parquet import read_cleaned
from salesmart.streaming import incremental, merge_latest

KEY = ["order_id", "product_id"]


def ok_rows(spark, *rows):
    return tag_quality(raw_df(spark, *rows)).filter(f"{QUALITY} = 'ok'").drop(QUALITY)


def test_a_merge_shuffles_no_whole_row_without_other_versions(spark, tmp_dir, monkeypatch):
    plans, write = [], VersionedTable.write

    def seen(self, content, commit):
        plans.append(content._jdf.queryExecution().executedPlan().toString())
        return write(self, content, commit)
    monkeypatch.setattr(VersionedTable, "write", seen)
    monkeypatch.setattr(incremental, "probe", lambda *a, **k: pytest.fail("the batch has rows of all months"))
    out = f"{tmp_dir}/cleaned"
    for k in range(2):
        merge_latest(spark, ok_rows(spark, *(row(order_id=f"O{k}-{m}", order_date=f"2024-{m:02d}-05") for m in range(1, 5))), out, f"b{k}")
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    assert read_cleaned(spark, out).count() == 8


@pytest.mark.parametrize("kw", [{}, {"few": 0}, {"most": 1}])
def test_latest_by_months_is_dedup_latest(spark, tmp_dir, kw):
    rows = spark.range(300).select(
        F.concat(F.lit("O"), (F.col("id") % 70).cast("string")).alias("order_id"), F.when(F.col("id") % 9 > 0, F.lit("P")).alias("product_id"),
        F.when(F.col("id") % 11 > 0, F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 90))")).alias("order_date"), (F.col("id") % 4).alias("n"))
    rows = rows.withColumn("year", F.year("order_date")).withColumn("month", F.month("order_date"))
    # some keys come once, and equal rows twice
    rows = rows.unionByName(rows.limit(20)).unionByName(rows.limit(30).withColumn("order_id", F.concat(F.lit("lone"), F.monotonically_increasing_id())))
    stored = incremental.stored(rows, f"{tmp_dir}/rows", "year", "month")
    plain = lambda df: sorted(map(repr, df.collect()))
    got = incremental.latest_by_months(stored, KEY, (), f"{tmp_dir}/t", **kw)
    assert plain(got) == plain(dedup_latest(stored, KEY, "order_date", ()))


@pytest.mark.parametrize("most", [0, 3, 100])
@pytest.mark.parametrize("left", [0, 2, 18])
def test_rows_of_stale_keys_leave(spark, tmp_dir, most, left):
    older = spark.range(20).select(F.col("id").cast("string").alias("order_id"), F.when(F.col("id") != 19, F.lit("p")).alias("product_id"), "id")
    stale = older.filter(F.col("id") >= left).select(*KEY)
    got = incremental.without_keys(older, stale, KEY, tmp_dir, most)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in older.join(stale, KEY, "left_anti").collect())


def test_drops_are_packed(spark, tmp_dir, monkeypatch):
    made = spark.range(80).select(*(F.lit(v).alias(c) for c, v in zip(raw_df(spark, row()).columns, row(), strict=True)),
                                  F.col("id").cast("int").alias("l_linenumber"), F.col("id").alias("l_suppkey")) \
        .withColumn("order_id", F.when(F.col("l_linenumber") > 1, F.concat(F.lit("ORD-"), F.col("l_linenumber").cast("string"))))
    monkeypatch.setattr(IO.Q, "raw", lambda spark, d: made)
    monkeypatch.setattr(IO, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    assert {(r["dt"], r["rows"], r["rejected"], r["open_files"]) for r in IO.q_file_ledger(spark, "unused").collect()} == {(d, 40, 1, 0) for d in IO.DROPS}
    assert read_cleaned(spark, f"{tmp_dir}/ledger/cleaned").filter("month = 12").count() == 0
    assert IO.q_stream_ingest(spark, "unused").count() == 78
    files = [f for top in ("ledger", "stream") for d in IO.DROPS for f in os.listdir(f"{tmp_dir}/{top}/input/dt={d}") if not f.startswith((".", "_"))]
    assert files and all(f.endswith(".csv.gz") for f in files)
