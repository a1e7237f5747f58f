"""What stage 1 doesn't sort, shuffle or write."""

import datetime as dt
import glob
import os
import re

from helpers import raw_df, row
from salesmart.operators import clean as C
from salesmart.plans import jobs
from salesmart.plans.jobs import Run, run_clean

ROWS = [row(order_id="ORD-1", sales_amount="18.00"), row(order_id="ORD-1", sales_amount="25.00", order_date="2024-02-01"),
        row(order_id="ORD-2", discount=""), row(order_id="ORD-3", quantity="x"), row(order_id="")]


def test_reconciliation_is_not_sorted_or_shuffled(spark):
    df = C.clean(raw_df(spark, *ROWS))
    p = df._jdf.queryExecution().optimizedPlan().toString()
    window = [line for line in p.split("\n") if re.search(r"\bWindow ", line)]
    assert window and not any("sales_amount_calc" in line or "sales_amount_flag" in line for line in window), p
    assert df.columns[-4:] == ["sales_amount_calc", "sales_amount_flag", "year", "month"]
    got = {r["order_id"]: (str(r["sales_amount_calc"]), r["sales_amount_flag"], r["month"]) for r in df.collect()}
    assert {k: (float(a), b, m) for k, (a, b, m) in got.items()} == {"ORD-1": (18.0, "MISMATCH", 2), "ORD-2": (20.0, "MISMATCH", 1)}


def test_staged_text_is_packed(spark, tmp_dir, monkeypatch):
    seen = []
    counted = jobs.committed_counts

    def counts(spark, staged, cleaned):
        seen.extend(glob.glob(f"{staged.removeprefix('file:')}/**/*.parquet", recursive=True))
        return counted(spark, staged, cleaned)
    monkeypatch.setattr(jobs, "committed_counts", counts)
    out = run_clean(spark, "", f"{tmp_dir}/c", f"{tmp_dir}/q", Run("r", dt.datetime(2024, 3, 1)), raw=raw_df(spark, *ROWS))
    assert seen and all(f.endswith(".zstd.parquet") for f in seen)
    assert (out["raw_rows"], out["valid_rows"], out["clean_rows"], out["duplicates_dropped"]) == (5, 3, 2, 1)


def test_malformed_lines_are_written_packed(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from salesmart.plans import io_queries as IO
    made = spark.range(160).select(*(F.lit(v).alias(c) for c, v in zip(raw_df(spark, row()).columns, row())),
                                   F.col("id").cast("int").alias("l_linenumber"), F.lit(0).cast("bigint").alias("l_suppkey")) \
        .withColumn("order_id", F.concat(F.lit("ORD-"), F.col("l_linenumber").cast("string")))
    monkeypatch.setattr(IO.Q, "raw", lambda spark, d: made)
    monkeypatch.setattr(IO, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    r = IO.q_malformed_records(spark, "unused").collect()[0]
    files = [f for f in os.listdir(f"{tmp_dir}/malformed/input") if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert r["raw_rows"] == 160 and r["traceable"] == r["malformed_record"] == 12 and r["clean_rows"] == 148


def table(path, spark):
    return sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=repr)


def versions(spark):
    """Keys with one version, several, equal ones, an undated one and one in another month."""
    rows = []
    for i in range(400):
        rows.append(row(order_id=f"ORD-{i % 90}", product_id=f"PROD-{i % 7}", region=("EU", "", "US")[i % 3], profit=str(i % 11),
                        quantity=str(1 + i % 5), sales_amount=("18.00", "-7.50", "", "250.00")[i % 4],
                        order_date="?" if i % 23 == 0 else (dt.date(2023, 1, 1) + dt.timedelta(days=9 * (i % 60))).isoformat()))
    return raw_df(spark, *rows, *rows[:40], row(order_id="", product_id="PROD-1")).repartition(5)


def shuffled(df):
    """Columns of every exchange of a plan."""
    p = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in p.split("\n") if "Exchange " in line and "Broadcast" not in line]


def test_months_are_written_as_clean_says_without_a_shuffle_of_rows(spark, tmp_dir, monkeypatch):
    from salesmart.sinks import write_cleaned
    raw, plans = versions(spark), []
    write_cleaned(C.clean(raw), f"{tmp_dir}/whole")
    written = jobs.write_months

    def months(df, path):
        plans.append(shuffled(df))
        written(df, path)
    monkeypatch.setattr(jobs, "write_months", months)
    want = table(f"{tmp_dir}/whole", spark)
    assert 90 * 7 > len(want) > 300
    for k, kw in enumerate((dict(), dict(file_rows=10), dict(file_rows=1), dict(most=3))):
        jobs.write_clean_months(spark, C.tag_quality(raw), f"{tmp_dir}/{k}", **kw)
        assert table(f"{tmp_dir}/{k}", spark) == want, kw
    assert plans == [[], [], []]      # nothing dealt; with too many repeated keys it is write_cleaned that writes


def test_hash_of_several_keys(spark, tmp_dir, monkeypatch):
    """Keys that share a hash keep a row each."""
    from pyspark.sql import functions as F
    raw = versions(spark)
    hashed = F.xxhash64
    jobs.write_clean_months(spark, C.tag_quality(raw), f"{tmp_dir}/a")
    monkeypatch.setattr(jobs.F, "xxhash64", lambda *c: F.pmod(hashed(*c), F.lit(5)))
    jobs.write_clean_months(spark, C.tag_quality(raw), f"{tmp_dir}/b")
    assert table(f"{tmp_dir}/a", spark) == table(f"{tmp_dir}/b", spark)


def test_months_of_no_rows(spark, tmp_dir):
    jobs.write_clean_months(spark, C.tag_quality(raw_df(spark, row(order_id=""))), f"{tmp_dir}/c")
    assert not [n for n in os.listdir(f"{tmp_dir}/c") if "=" in n]


def test_small_months_share_tasks_and_none_holds_all(spark, tmp_dir):
    rows = spark.range(4000).selectExpr("id", "cast(1990 + id % 40 as int) year", "cast(1 + id % 12 as int) month").repartition(3)
    rows.write.partitionBy("year", "month").parquet(f"{tmp_dir}/m")
    read = spark.read.schema("id bigint, year int, month int").parquet(f"{tmp_dir}/m")
    dealt = jobs.by_months(read, 500)
    assert sorted(r["id"] for r in dealt.select("id").collect()) == list(range(4000))
    assert 8 <= dealt.rdd.getNumPartitions() <= 40


def test_stage_two_shuffles_no_line_for_its_totals(spark):
    from salesmart.operators import kpis as K
    sales = C.clean(versions(spark))
    for name, args in K.ORDERS_APART.items():
        whole, apart = K.KPI_DATASETS[name].fn(sales), K.orders_apart(K.KPI_DATASETS[name].fn, *args)(sales)
        assert whole.schema.names == apart.schema.names and [f.dataType for f in whole.schema] == [f.dataType for f in apart.schema]
        assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, apart.collect()), key=repr), name
        assert not [line for line in shuffled(apart) if "order_id" in line and "sum" in line]


def test_leading_products_hold_the_first(spark, tmp_dir):
    """Many products, negative and NULL amounts, ties at the last place, a region of few products and one without amounts."""
    from salesmart.operators import kpis as K
    rows = [row(order_id=f"O{i}", product_id=f"P{i % 97}", product_name=f"n{i % 194}", category="" if i % 31 == 0 else "c",
                region="EU" if i % 5 else "", sales_amount=str((i * 37) % 50 - (400 if i % 97 < 20 and i % 2 else 0))) for i in range(1200)]
    rows += [row(order_id=f"A{i}", product_id=f"P{i}", region="FEW", sales_amount="5" if i else "") for i in range(3)]
    rows += [row(order_id=f"B{i}", product_id=f"P{i}", region="NONE", sales_amount="") for i in range(15)]
    rows += [row(order_id=f"C{i}", product_id=f"P{i}", region="TIES", sales_amount="5" if i > 4 else "9") for i in range(40)]
    sales = C.clean(raw_df(spark, *rows)).cache()
    def kept(df, name):
        df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_dir}/{name}")
    bounds = kept(K.product_bounds(sales), "bounds")
    leading = K.leading_products(bounds, sales, kept)
    few = K.of_products(sales, leading)
    got, want = (sorted(map(tuple, K.top_products_by_region(x).collect()), key=repr) for x in (few, sales))
    assert got == want and {r[0] for r in want} == {"EU", None, "FEW", "NONE", "TIES"}
    assert few.filter("region = 'EU'").count() < 0.9 * sales.filter("region = 'EU'").count()
    tables = jobs.stored_tables(sales, f"{tmp_dir}/s")
    assert sorted(map(tuple, tables["top_products_by_region"].collect()), key=repr) == want
    sales.unpersist()


def test_grains_deal_an_order_once_and_without_amounts(spark):
    """Orders in several groups of every grain, lines without an order and NULL keys: each grain as an aggregate of the lines."""
    from pyspark.sql import functions as F

    from salesmart.operators import kpis as K
    sales = C.clean(versions(spark)).withColumn("order_id", F.when(F.col("quantity") < 5, F.col("order_id"))) \
        .withColumn("sub_category", F.when(F.col("month") % 5 > 0, F.col("product_id"))).cache()
    sales.createOrReplaceTempView("grains")
    for fn, keys, sets in ((K.regional_grouping_sets, "region, country, year, month", "(region, country, year, month), (region, country), (region), ()"),
                           (K.category_rollup, "category, sub_category", "(category, sub_category), (category), ()")):
        got = fn(sales)
        want = spark.sql(f"SELECT {keys}, grouping_id() AS grain, round(sum(sales_amount), 2) AS total_revenue, sum(quantity) AS total_units_sold, "
                         f"count(DISTINCT order_id) AS total_orders, round(sum(sales_amount) / nullif(count(DISTINCT order_id), 0), 2) AS revenue_per_order "
                         f"FROM grains GROUP BY GROUPING SETS ({sets})")
        plain = lambda df: sorted((tuple(None if v is None else str(float(v)) if not isinstance(v, str) else v for v in r) for r in df.select(*want.columns).collect()), key=repr)  # noqa: E731,B023
        assert plain(got) == plain(want) and len(plain(want)) > 3
        dealt = [line for line in shuffled(got) if "order_id" in line]
        assert len([line for line in dealt if re.search(r"hashpartitioning\(order_id#\d+, \d+\)", line)]) == 1
        assert not any(c in line for line in dealt for c in keys.split(", "))
    assert K.category_rollup(sales.filter("false")).count() == 0
    sales.unpersist()


def test_queries_from_staged_months_shuffle_no_row_for_its_versions(spark):
    from conftest import SF_SMALL

    from salesmart.plans import queries as Q
    for df in (Q.stored(spark, SF_SMALL), Q.leading(spark, SF_SMALL)):
        assert shuffled(df) == []
    assert shuffled(Q.cleaned(spark, SF_SMALL))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(Q.stored(spark, SF_SMALL)) == rows(Q.cleaned(spark, SF_SMALL))
