"""Synthetic sales (G1/G2): deterministic per row id, right shapes, dirt classified."""

from pyspark.sql import functions as F

from salesmart.operators import clean as C
from salesmart.operators.synth import synth_sales, with_dirt


def test_synth_is_deterministic_and_well_formed(spark):
    ids = spark.range(0, 3000, numPartitions=3).withColumnRenamed("id", "k")
    a = synth_sales(ids).collect()
    b = synth_sales(ids.repartition(7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    t = C.tag_quality(synth_sales(ids))
    assert t.filter("quality <> 'ok'").count() == 0
    assert t.filter("sales_amount_flag <> 'OK'").count() == 0
    assert t.agg(F.min("order_date"), F.max("order_date")).collect()[0][0].year == 2021
    assert t.select("region", "country").distinct().count() == 21


def test_dirt_is_added_not_replaced(spark):
    raw = synth_sales(spark.range(0, 5000).withColumnRenamed("id", "k"))
    dirty = with_dirt(raw, 0.02)
    extra = dirty.count() - 5000
    assert 50 < extra < 150
    tags = {r["quality"]: r["count"] for r in C.tag_quality(dirty).groupBy("quality").count().collect()}
    assert tags["ok"] >= 5000 and sum(v for k, v in tags.items() if k != "ok") > 0.5 * extra


def test_rows_with_bad_dates_survive_dedup(spark):
    dirty = with_dirt(synth_sales(spark.range(0, 20_000).withColumnRenamed("id", "k")), 0.05)
    bad = dirty.filter("order_date = 'not-a-date'").count()
    assert bad > 100 and C.undated_rows(C.clean(dirty)).count() == bad


def test_generate_command(spark, tmp_dir):
    from salesmart.plans.cli import main
    from salesmart.sources.csv import read_raw_sales
    main(["generate", "--rows", "500", "--output", f"{tmp_dir}/raw", "--dirt", "0.1"])
    raw = read_raw_sales(spark, f"{tmp_dir}/raw", header_check=True)
    assert 520 < raw.count() < 600 and raw.filter("customer_id = '  '").count() > 0
