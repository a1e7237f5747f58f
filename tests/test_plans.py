"""Physical-plan properties that matter at scale."""

from conftest import SF_SMALL
from salesmart.operators import kpis as K
from salesmart.plans import queries as Q
from salesmart.sources.parquet import read_cleaned
from salesmart.sinks import write_cleaned


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_and_top_n_limit_before_shuffle(spark):
    for df in (Q.cleaned(spark, SF_SMALL), K.top_products_by_region(Q.cleaned(spark, SF_SMALL))):
        p = plan(df)
        assert p.count("WindowGroupLimit") >= 2, p      # partial (map side) + final
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_no_python_anywhere(spark):
    from __spark_entry__ import queries
    for k in ("region_country_monthly", "overall_kpi", "customer_segments", "regional_grouping_sets"):
        p = plan(queries()[k](spark, SF_SMALL))
        assert "Python" not in p, k


def test_mom_window_has_no_range_sort_exchange(spark):
    p = plan(K.monthly_trend(Q.cleaned(spark, SF_SMALL)))
    assert "rangepartitioning" not in p.lower()


def test_period_filter_prunes_partitions(spark, tmp_dir):
    write_cleaned(Q.cleaned(spark, SF_SMALL), tmp_dir)
    df = read_cleaned(spark, tmp_dir, periods=[(1996, 3)])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "year" in p.split("PartitionFilters")[1][:200]
    assert df.select("year", "month").distinct().collect() == [(1996, 3)]


def test_kpi_scan_reads_only_needed_columns(spark, tmp_dir):
    write_cleaned(Q.cleaned(spark, SF_SMALL), tmp_dir)
    p = plan(K.payment_distribution(read_cleaned(spark, tmp_dir)))
    schema = p.split("ReadSchema: ")[1].split("\n")[0] if "ReadSchema: " in p else p
    assert "product_name" not in schema and "sales_amount" in schema


def test_customer_grain_kpi_is_not_coalesced(spark, tmp_dir):
    from salesmart.operators.kpis import KPI_DATASETS, customer_segments
    from salesmart.sinks import write_kpi
    assert KPI_DATASETS["customer_segments"].bounded is False
    df = customer_segments(Q.cleaned(spark, SF_SMALL), as_of=Q.AS_OF)
    write_kpi(df, tmp_dir, "customer_segments", bounded=False)
    assert spark.read.parquet(f"{tmp_dir}/customer_segments").count() == df.count()


def test_results_with_the_large_cluster_join_plan(spark):
    """With Spark's size-based broadcast off (what 100 TB implies), joins become sort-merge
    and results still equal the oracle."""
    from oracle_check import compare, duck
    import __spark_entry__ as E
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        q = E.queries()["region_country_monthly"]
        p = plan(q(spark, SF_SMALL))
        assert p.count("SortMergeJoin") >= 3
        r = compare(spark, duck(SF_SMALL), "region_country_monthly", SF_SMALL, q, E.oracle_sql()["region_country_monthly"])
        assert r["ok"], r.get("detail")
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_grouping_sets_expand_above_an_aggregate(spark):
    for fn in (K.regional_grouping_sets, K.category_rollup):
        p = plan(fn(Q.cleaned(spark, SF_SMALL)))
        below = p[p.index("Expand"):]
        assert "HashAggregate" in below.split("Window")[0], p
