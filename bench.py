"""Benchmark: the three stage jobs and headline queries over the driver's tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (3),
BENCH_CHECKPOINT_DIR (default: the session's spark.checkpoint.dir). Prints one JSON line; each time
is the median of BENCH_REPEAT runs after one warm-up run, under the library's own session settings.
Queries read the cleaned Parquet table and run to completion through the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.operators import kpis as K  # noqa: E402
from salesmart.plans import queries as Q  # noqa: E402
from salesmart.plans.jobs import Run, run_clean, run_consolidate  # noqa: E402
from salesmart.session import get_spark, scratch_path  # noqa: E402
from salesmart.sinks import write_kpi  # noqa: E402
from salesmart.sinks.files import Files  # noqa: E402
from salesmart.sources.fixtures import FIXTURE_TIES  # noqa: E402
from salesmart.sources.parquet import read_cleaned  # noqa: E402
from salesmart.sources.csv import read_raw_sales  # noqa: E402
from salesmart.plans.io_queries import FIXTURE_RAW_SCHEMA, write_raw_csv  # noqa: E402

HEADLINE = {
    "region_country_monthly": K.region_country_monthly, "category_monthly": K.category_monthly,
    "monthly_trend": K.monthly_trend, "top_products_by_region": K.top_products_by_region,
    "customer_segments": lambda s: K.customer_segments(s, as_of=Q.AS_OF, high=Q.HIGH, mid=Q.MID),
    "overall_kpi": K.overall_kpi, "regional_grouping_sets": K.regional_grouping_sets, "category_rollup": K.category_rollup,
}


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    fn()  # warm-up
    ts = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t)
    return round(statistics.median(ts), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    extra = {"spark.driver.memory": "8g", "spark.eventLog.enabled": "false"}
    if os.environ.get("BENCH_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = os.environ["BENCH_CHECKPOINT_DIR"]
    spark = get_spark(f"local[{cpus}]", "salesmart-bench", shuffle_partitions=2 * cpus, extra=extra)
    base = scratch_path(spark, "bench")
    run = Run(run_id="bench", run_ts=Q.RUN_TS)
    cleaned, quar, kpi_base = f"{base}/cleaned", f"{base}/quarantine", f"{base}/aggregated"
    times: dict[str, float] = {}

    # setup (untimed): the raw sales rows land as CSV files in dt= folders, as the original's input
    raw_in = f"{base}/input"
    write_raw_csv(Q.raw(spark, sf_dir), f"{raw_in}/sales")
    raw_schema = FIXTURE_RAW_SCHEMA

    # stage 1: raw CSV -> tagged -> cleaned parquet + quarantine
    times["stage1_clean"] = timed(lambda: run_clean(
        spark, "", cleaned, quar, run, raw=read_raw_sales(spark, raw_in, schema=raw_schema),
        ties=FIXTURE_TIES), repeat)

    # stage 2: each KPI table from the cleaned parquet (pruned scan), written as parquet
    sales = read_cleaned(spark, cleaned).select(*K.KPI_INPUT_COLUMNS)
    for name, spec in K.KPI_DATASETS.items():
        kw = dict(as_of=Q.AS_OF, high=Q.HIGH, mid=Q.MID) if name == "customer_segments" else {}
        times[f"stage2_{name}"] = timed(
            lambda n=name, s=spec, k=kw: write_kpi(s.fn(sales, **k), kpi_base, n, s.partitions, s.bounded), repeat)

    # stage 3: report + manifest from the KPI tables
    times["stage3_report"] = timed(lambda: run_consolidate(spark, kpi_base, base, run), repeat)

    # headline queries: cleaned table -> result
    for name, fn in HEADLINE.items():
        times[f"query_{name}"] = timed(lambda f=fn: noop(f(sales)), repeat)
    Files(spark).delete(base)

    stage_total = round(sum(v for k, v in times.items() if k.startswith("stage")), 3)
    n_raw = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "pipeline_total_sec", "value": stage_total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus, "repeat": repeat,
        "rows": {"raw_sales_lines": n_raw},
        "pipeline_rows_per_sec": round(n_raw / stage_total) if stage_total else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
