"""The three stage jobs: raw text -> cleaned fact -> KPI tables -> JSON report.

Each job is a thin driver over the operators; only literals (run id, timestamps) come from
the driver, all data work is Spark's. Outputs are overwritten as a whole or per partition,
so a rerun after a failure converges to the same result.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import kpis as K
from salesmart.operators import report as R
from salesmart.operators import summary as B
from salesmart.operators.clean import QUALITY, RECONCILED, clean, flag_sales, recalc_sales, rejected, type_rows, valid_rows, with_audit, with_period, with_quality
from salesmart.operators.quality import committed_counts
from salesmart.operators.windows import dedup_latest
from salesmart.schema import DEDUP_KEY, FILE_ROWS, REPEATED_KEYS
from salesmart.session import scratch_path
from salesmart.sinks import report_path, write_cleaned, write_json_text, write_kpi, write_months, write_quarantine
from salesmart.sinks.files import Files
from salesmart.sources.csv import read_raw_sales
from salesmart.sources.parquet import cached, read_cleaned, read_kpi


@dataclass(frozen=True)
class Run:
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_ts: _dt.datetime = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc)
                                 .replace(tzinfo=None, microsecond=0))
    job: str = "salesmart"

    @property
    def run_date(self) -> _dt.date:
        return self.run_ts.date()


def run_clean(spark: SparkSession, input_path: str, cleaned_path: str, quarantine_path: str, run: Run,
              *, header_check: bool = False, raw: DataFrame | None = None, ties=(), files: int | None = None,
              malformed: bool = False) -> dict:
    """Stage 1, in one scan of the raw text. Returns the run counters.

    The standardized text goes to a scratch table by quality class; the cleaned table is made of its class ``ok``, the
    quarantine of the others, each from its own folders. The counters are those of the committed files, so they are
    exact whatever tasks were lost and run again. ``malformed`` makes lines of too few or too many fields a class of
    their own.
    """
    raw = read_raw_sales(spark, input_path, header_check=header_check, malformed=malformed) if raw is None else raw
    staged = scratch_path(spark, f"tagged-{run.run_id}")
    tagged = with_quality(raw)
    try:
        tagged.write.partitionBy(QUALITY).option("compression", "zstd").parquet(staged)      # text, read twice and then deleted
        rows = spark.read.schema(tagged.schema).parquet(staged)
        audited = lambda df: with_audit(df, run.job, run.run_ts, "etl_processed_at")
        if files:
            write_cleaned(audited(clean(raw, tagged=type_rows(rows), ties=ties)), cleaned_path, files)
        else:
            write_clean_months(spark, type_rows(rows), cleaned_path, ties=ties, finish=audited)
        write_quarantine(rejected(rows, run.run_ts), quarantine_path, run.run_id)
        return committed_counts(spark, staged, cleaned_path)
    finally:
        Files(spark).delete(staged)


ROW, PERIOD = "_row", ("year", "month")
BRANCHES = 64      # scans side by side in the job that writes the cleaned table (at most twice as many)


def write_clean_months(spark: SparkSession, tagged: DataFrame, path: str, *, ties=(), finish: Callable[[DataFrame], DataFrame] = lambda df: df,
                       most: int = REPEATED_KEYS, file_rows: int = FILE_ROWS) -> None:
    """``clean`` over ``tagged`` rows, and ``write_cleaned`` of what ``finish`` makes of it, without a shuffle of the rows
    (``clean_by_months``)."""
    root = scratch_path(spark, "valid")
    try:
        rows, by_month = clean_by_months(spark, tagged, root, ties=ties, most=most, file_rows=file_rows)
        (write_months if by_month else write_cleaned)(finish(rows), path)
    finally:
        Files(spark).delete(root)


def clean_by_months(spark: SparkSession, tagged: DataFrame, root: str, *, ties=(), most: int = REPEATED_KEYS,
                    file_rows: int = FILE_ROWS) -> tuple[DataFrame, bool]:
    """``clean`` over ``tagged`` rows without a shuffle of them, and whether each month's rows are in few tasks; it reads tables that are
    written below ``root``.

    The valid rows are staged by month, as they come. Rows whose key's hash is there once have no other version; the others alone go
    through ``dedup_latest``, whose kept rows are then known by number. The staged months are read again, each by tasks of its own
    (or with its neighbours, if it is small), without the rows that weren't kept, so a month has few files though no row was dealt.
    With more than ``most`` repeated hashes, which every task would have to know, all rows are deduplicated.
    """
    valid = with_period(valid_rows(tagged).drop(*RECONCILED))
    names = [c for c in valid.columns if c not in PERIOD]
    staged = valid.withColumn(ROW, F.monotonically_increasing_id())
    staged.write.partitionBy(*PERIOD).option("compression", "zstd").parquet(f"{root}/rows")
    rows = spark.read.schema(staged.schema).parquet(f"{root}/rows")
    key_hash = F.xxhash64(*DEDUP_KEY)
    rows.groupBy(key_hash.alias("_hash")).count().filter("count > 1").select("_hash").write.parquet(f"{root}/repeated")
    repeated = spark.read.schema("_hash bigint").parquet(f"{root}/repeated")
    cleaned = lambda kept: flag_sales(recalc_sales(kept)).select(*names, *RECONCILED, *PERIOD)
    if repeated.count() > most:
        return cleaned(dedup_latest(rows.select(*names, *PERIOD), DEDUP_KEY, "order_date", ties)), False
    some = rows.join(F.broadcast(repeated), key_hash == F.col("_hash"), "left_semi").select(*names, ROW)
    latest = dedup_latest(some, DEDUP_KEY, "order_date", ties)       # the number comes last among the ties
    latest.groupBy(key_hash.alias("_hash")).agg(F.collect_set(ROW).alias("_kept")).write.parquet(f"{root}/kept")
    kept = spark.read.schema("_hash bigint, _kept array<bigint>").parquet(f"{root}/kept")      # a row for a repeated hash
    only = by_months(rows, file_rows).join(F.broadcast(kept), key_hash == F.col("_hash"), "left") \
        .filter(F.col("_kept").isNull() | F.array_contains("_kept", F.col(ROW)))
    return cleaned(only), True


def by_months(rows: DataFrame, file_rows: int) -> DataFrame:
    """A table of (year, month) folders, read by tasks of about ``file_rows`` rows that have few months each; nothing is shuffled."""
    counts = rows.groupBy(*PERIOD).count().collect()      # bounded by the calendar
    total = sum(r["count"] for r in counts)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(file_rows, max(total // (2 * cores), file_rows // 10)))
    undated = -2**31
    at = F.coalesce(F.col("year") * 12 + F.col("month"), F.lit(undated))
    spans: list[list[int]] = []
    for i, n in sorted((undated if r["year"] is None else r["year"] * 12 + r["month"], r["count"]) for r in counts):
        if spans and spans[-1][2] + n <= max(size, total // BRANCHES):
            spans[-1][1:] = i, spans[-1][2] + n
        else:
            spans.append([i, i, n])
    parts = [rows.filter((at >= lo) & (at <= hi)).coalesce(-(-n // size)) for lo, hi, n in spans]
    # a union of single partitions alone would be one partition, so it gets a scan of no files
    return reduce(DataFrame.unionAll, parts, rows.filter(at > spans[-1][1])) if parts else rows


def kpi_tables(sales: DataFrame, as_of=None, thresholds: dict | None = None) -> dict[str, DataFrame]:
    """The eight stage-2 tables over a cleaned frame (no audit columns)."""
    out = {}
    for name, spec in K.KPI_DATASETS.items():
        kw = dict(as_of=as_of, **(thresholds or {})) if name == "customer_segments" else {}
        out[name] = spec.fn(sales, **kw)
    return out


def run_aggregate(spark: SparkSession, cleaned_path: str, kpi_base: str, run: Run, *, as_of=None,
                  thresholds: dict | None = None, cache: bool = False) -> dict[str, str]:
    """Stage 2: the eight KPI tables, each with audit columns, written under ``kpi_base``.

    By default each table scans the cleaned parquet for just its own columns, which stays
    cheap at any size. ``cache=True`` (the original's choice) persists the pruned input once
    (memory, spilling to disk) for the eight aggregations; worth it only when the cleaned
    table fits comfortably in the cluster's memory.
    """
    sales = read_cleaned(spark, cleaned_path).select(*K.KPI_INPUT_COLUMNS)
    scratch, paths = scratch_path(spark, "stage2"), {}

    def write_all(src: DataFrame):
        for name, df in (kpi_tables(src, as_of, thresholds) | stored_tables(src, scratch)).items():
            spec = K.KPI_DATASETS[name]
            paths[name] = write_kpi(with_audit(df, run.job, run.run_ts, spec.ts_col), kpi_base, name,
                                    spec.partitions, spec.bounded)

    try:
        if cache:
            with cached(sales) as s:
                write_all(s)
        else:
            write_all(sales)
    finally:
        Files(spark).delete(scratch)
    return paths


def stored_tables(sales: DataFrame, scratch: str) -> dict[str, DataFrame]:
    """The tables that shuffle less if a stored table is scanned more than once: A1-A3 count orders beside their totals, A4 looks
    for the products that can lead a region before it reads their lines."""
    out = {name: K.orders_apart(K.KPI_DATASETS[name].fn, *args)(sales) for name, args in K.ORDERS_APART.items()}

    leading = of_leading_products(sales, scratch)
    if leading is not None:
        out["top_products_by_region"] = K.top_products_by_region(leading)
    return out


def of_leading_products(sales: DataFrame, scratch: str) -> DataFrame | None:
    """The lines of a stored table that A4 needs: those of products that can lead a region; None if these are so many that a semi-join
    would shuffle the lines once more."""
    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")      # a table's size is known when a join with it is planned
        return df.sparkSession.read.schema(df.schema).parquet(f"{scratch}/{name}")
    leading = kept(K.leading_products(kept(K.product_bounds(sales), "bounds"), sales, kept), "leading")
    return K.of_products(sales, leading) if leading.count() <= REPEATED_KEYS else None


def stage3_sections(spark: SparkSession, kpi_base: str) -> dict[str, DataFrame]:
    t = {n: read_kpi(spark, kpi_base, n) for n in K.KPI_DATASETS}
    return {
        "overall_kpi": t["overall_kpi"],
        "regional_summary": B.regional_summary(t["region_country_monthly"]),
        "category_summary": B.category_summary(t["category_monthly"]),
        "monthly_trends": B.monthly_trends(t["monthly_trend"]).drop("position"),
        "top_products": t["top_products_by_region"],
        "customer_segments": B.segment_status_summary(t["customer_segments"]),
        "segment_totals": B.segment_totals(t["customer_segments"]),
        "payment_distribution": B.payment_summary(t["payment_distribution"]),
        "order_status_summary": B.status_summary(t["order_status_summary"]),
    }


def run_consolidate(spark: SparkSession, kpi_base: str, out_base: str, run: Run) -> dict[str, str]:
    """Stage 3: the nested JSON report and its manifest under ``consolidated/YYYY/MM/DD/``."""
    report = R.build_report(stage3_sections(spark, kpi_base), run.run_id, run.run_ts, run.job)
    report = report.persist()  # one bounded row, used by both writes
    try:
        rpath = report_path(out_base, run.run_date, run.run_id)
        size = write_json_text(R.report_json(report), rpath)
        mpath = report_path(out_base, run.run_date, run.run_id, "manifest")
        m = R.manifest(report, run.run_id, run.run_ts, rpath, size)
        write_json_text(m.select(F.to_json(F.struct(*m.columns), {"pretty": "true"}).alias("json")), mpath)
    finally:
        report.unpersist()
    return {"report": rpath, "manifest": mpath}


def run_all(spark: SparkSession, input_path: str, base: str, run: Run | None = None, **kw) -> dict:
    """Stages 1-3 in order, then V3: the run's report must exist and agree with its manifest."""
    from salesmart.operators.quality import verify_report
    run = run or Run()
    cleaned, quar, kpi = f"{base}/cleaned", f"{base}/quarantine", f"{base}/aggregated"
    metrics = run_clean(spark, input_path, cleaned, quar, run)
    run_aggregate(spark, cleaned, kpi, run, as_of=kw.get("as_of"), thresholds=kw.get("thresholds"))
    out = run_consolidate(spark, kpi, base, run)
    mine = verify_report(spark, base, run.run_date).filter(F.col("run_id") == run.run_id).collect()  # one row
    if not mine or not mine[0]["counts_match"] or not mine[0]["size_matches"] or mine[0]["status"] != "SUCCESS":
        raise RuntimeError(f"report verification failed for run {run.run_id}")
    return {"metrics": metrics, **out, "verified": True}
