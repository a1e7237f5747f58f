"""Named queries that cover I/O, the report and the incremental path.

Each writes to a fresh folder under the session's shared checkpoint root and reads back,
so the returned frame is what a later job would see.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import report as R
from salesmart.operators.clean import clean, drop_audit, quarantine, standardize_text, undated_rows
from salesmart.operators.membership import blocks_for, build_filters, probe, with_blocks
from salesmart.operators.quality import verify_report
from salesmart.plans import queries as Q
from salesmart.plans.jobs import run_clean, run_consolidate, write_clean_months
from salesmart.plans.refresh import refresh_aggregates
from salesmart.schema import RAW_SCHEMA
from salesmart.session import scratch_path
from salesmart.sinks import write_quarantine
from salesmart.sinks.files import Files
from salesmart.sinks.versions import VersionedTable
from salesmart.sources.catalog import read_registered, update_table
from salesmart.sources.csv import infer_raw_schema, read_raw_sales, schema_drift
from salesmart.sources.fixtures import FIXTURE_TIES, sales_view
from salesmart.sources.parquet import read_cleaned, read_kpi

# raw schema of the fixture files: the 18 text columns plus the lineage columns
FIXTURE_RAW_SCHEMA = T.StructType(RAW_SCHEMA.fields + [
    T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_suppkey", T.LongType())])
DROPS = ("2001-08-01", "2001-08-02")


def drop_of(col: str = "l_suppkey"):
    """Ingest day of a fixture row: even supplier keys land first, odd ones a day later."""
    return F.when(F.col(col) % 2 == 0, F.lit(DROPS[0])).otherwise(F.lit(DROPS[1]))


PACKED = "*.csv.gz"


def write_raw_csv(raw: DataFrame, path: str, partition_by_dt: bool = True, compression: str = "none") -> None:
    """Fixture raw rows as header CSV files (whitespace kept), in ``dt=`` ingest folders."""
    w = raw.withColumn("dt", drop_of()) if partition_by_dt else raw
    w = (w.write.mode("overwrite").option("header", "true").option("escape", '"').option("compression", compression)
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    (w.partitionBy("dt") if partition_by_dt else w).csv(path)


def q_raw_scan(spark: SparkSession, d: str) -> DataFrame:
    """Raw text through CSV files in dt= folders and back, standardized."""
    path = scratch_path(spark, "raw")
    write_raw_csv(Q.raw(spark, d), path)
    return standardize_text(read_raw_sales(spark, path, schema=FIXTURE_RAW_SCHEMA))


def q_cleaned_scan(spark: SparkSession, d: str) -> DataFrame:
    """K1 + S3: cleaned fact written partitioned by (year, month) and read back."""
    path = scratch_path(spark, "cleaned")
    write_clean_months(spark, Q.tagged(spark, d), path, ties=FIXTURE_TIES)
    return read_cleaned(spark, path)


def q_schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """Types inferred from the raw files vs the all-STRING contract."""
    path = scratch_path(spark, "raw")
    write_raw_csv(Q.raw(spark, d), path, partition_by_dt=False)
    return schema_drift(spark, FIXTURE_RAW_SCHEMA, infer_raw_schema(spark, path))


def q_catalog_changes(spark: SparkSession, d: str) -> DataFrame:
    """A folder registered before and after its header changed: each column's changes, and in how many rows the table
    registered last has a value."""
    root = scratch_path(spark, "catalog")
    table = f"catalog_{root.rsplit('-', 1)[1]}"
    sales = sales_view(spark, d).select("order_id", "quantity", "unit_price", "discount", "region", "status", "l_linenumber", "l_suppkey")
    even = F.col("l_suppkey") % 2 == 0
    first = sales.filter(even).select("order_id", "quantity", "l_linenumber", "region", "discount")
    # quantity comes as a fraction, region is missing, status is new and stands before the others
    second = sales.filter(~even).select("status", "order_id", (F.col("quantity") * Decimal("1.5")).alias("quantity"), "l_linenumber", "discount")
    changes = None
    for k in range(3):
        if k < 2:
            write_raw_csv((first, second)[k], f"{root}/input/dt={DROPS[k]}", partition_by_dt=False)
        else:      # the first day's files expire, and no file has a region any more
            Files(spark).delete(f"{root}/input/dt={DROPS[0]}")
        rows = update_table(spark, f"{root}/input", table, f"{root}/log", f"run-{k}", Q.RUN_TS + _dt.timedelta(days=k))
        changes = rows if changes is None else changes.unionByName(rows)
    now = read_registered(spark, f"{root}/input", table, f"{root}/log")
    filled = now.agg(*(F.count(c).alias(c) for c in now.columns))
    filled = filled.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in now.columns))).alias("x")).select("x.*")
    registered = spark.table(table).dtypes
    spark.sql(f"DROP TABLE {table}")
    types = spark.createDataFrame(registered, "column string, registered_type string")
    return changes.join(filled, "column").join(types, "column").select(
        "run_id", "column", "change", "old_type", "new_type", "position", "registered_type", "filled")


def _report(spark, d) -> DataFrame:
    return R.build_report(Q.sections(spark, d), Q.RUN_ID, Q.RUN_TS, Q.JOB)


def q_report_json(spark: SparkSession, d: str) -> DataFrame:
    """The whole report as one JSON document."""
    return R.report_json(_report(spark, d))


REPORT_KPI_SCHEMA = (
    "struct<metadata:struct<data_range:struct<`from`:string,`to`:string>,"
    "customer_segment_totals:map<string,bigint>>,"
    "overall_kpi:struct<grand_total_revenue:double,grand_total_profit:double,overall_profit_margin_pct:double,"
    "total_units_sold:bigint,total_orders:bigint,unique_customers:bigint,unique_products:bigint,"
    "avg_order_value:double,data_from:string,data_to:string>,"
    "top_products:map<string,array<struct<product_id:string,rank_in_region:int>>>>")


def q_report_json_values(spark: SparkSession, d: str) -> DataFrame:
    """K4 read back: values parsed from the JSON text (numbers, ISO times, maps) survive rendering."""
    doc = F.from_json("json", REPORT_KPI_SCHEMA)
    return R.report_json(_report(spark, d)).select(doc.alias("doc")).select(
        "doc.overall_kpi.*",
        F.col("doc.metadata.data_range.from").alias("range_from"),
        F.col("doc.metadata.data_range.to").alias("range_to"),
        F.col("doc.metadata.customer_segment_totals")["HIGH_VALUE"].alias("high_value_customers"),
        F.size(F.map_keys("doc.top_products")).cast("bigint").alias("top_product_regions"),
    )


REPORT_ARRAYS = {
    # section: (label fields, amount, count)
    "regional_summary": (("region", "country"), "total_revenue", "total_orders"),
    "category_summary": (("category", "sub_category"), "total_revenue", "total_orders"),
    "monthly_trends": (("year", "month", "region"), "monthly_revenue", "monthly_orders"),
    "customer_segments": (("customer_segment", "customer_status"), "total_lifetime_value", "customer_count"),
    "payment_distribution": (("region", "payment_method"), "total_revenue", "transaction_count"),
    "order_status_summary": (("region", "status"), "total_revenue", "order_count"),
}
_TOP = (("region", "rank_in_region", "product_id"), "total_revenue", "total_orders")


def _element(fields: tuple) -> str:
    labels, amount, count = fields
    return "struct<" + ",".join(f"{c}:string" for c in labels) + f",{amount}:double,{count}:bigint>"


def q_report_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Every element of every array of the JSON report, with its place."""
    schema = "struct<" + ",".join(f"{n}:array<{_element(f)}>" for n, f in REPORT_ARRAYS.items()) + \
        f",top_products:map<string,array<{_element(_TOP)}>>>"
    doc = R.report_json(_report(spark, d)).select(F.from_json("json", schema).alias("doc"))

    def rows(name: str, array, fields: tuple):
        labels, amount, count = fields
        label = lambda x: F.concat_ws("|", *[F.coalesce(x[c], F.lit("-")) for c in labels])
        return F.transform(array, lambda x, i: F.struct(
            F.lit(name).alias("section"), i.cast("bigint").alias("position"), label(x).alias("label"),
            x[amount].alias("amount"), x[count].alias("n")))
    top = F.flatten(F.transform(F.map_values("doc.top_products"), lambda a: rows("top_products", a, _TOP)))
    return doc.select(F.inline(F.concat(*[rows(n, F.col(f"doc.{n}"), f) for n, f in REPORT_ARRAYS.items()], top)))


def _consolidated(spark, d) -> tuple[str, dict]:
    base = scratch_path(spark, "mart")
    Q.kpi_tables(spark, d, base)
    return base, run_consolidate(spark, f"{base}/aggregated", base, Q.RUN)


def q_verify_report(spark: SparkSession, d: str) -> DataFrame:
    """V3: a whole consolidation's report, read back beside its manifest."""
    base, _ = _consolidated(spark, d)
    return verify_report(spark, base, Q.RUN.run_date).select("run_id", "status", "counts_match", "size_matches", "report_counts.*")


def q_report_file(spark: SparkSession, d: str) -> DataFrame:
    """K4/K5: report and manifest are one object each; the manifest's size is the file's."""
    _, out = _consolidated(spark, d)
    files = Files(spark)
    man = spark.read.option("multiLine", "true").json(out["manifest"])
    return man.select("run_id", F.lit(files.is_file(out["report"])).alias("report_is_file"),
                      F.lit(files.is_file(out["manifest"])).alias("manifest_is_file"),
                      (F.col("file_size_bytes") == files.size(out["report"])).alias("size_matches"))


def q_quarantine_sink(spark: SparkSession, d: str) -> DataFrame:
    """K2: quarantine written under its run and read back; a rerun replaces it."""
    path = scratch_path(spark, "quarantine")
    rejected = quarantine(Q.raw(spark, d), Q.RUN_TS)
    for _ in range(2):
        write_quarantine(rejected, path, Q.RUN_ID)
    return spark.read.parquet(path)


def q_malformed_records(spark: SparkSession, d: str) -> DataFrame:
    """Stage 1 over lines of which some are short, long or have an open quote: every class as counted in the committed
    files, and the quarantine's malformed lines with their file and text."""
    root = scratch_path(spark, "malformed")
    # as FIXTURES.md §3: a bucket of the line's keys says what is wrong with it
    bucket = F.pmod(F.col("l_suppkey") * 3 + F.col("l_linenumber"), F.lit(40))
    rows = Q.raw(spark, d)
    line = lambda *more: F.to_csv(F.struct(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in RAW_SCHEMA.names), *more), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    short = F.regexp_replace(line(), ",[^,]*$", "")
    opened = F.concat(F.lit('"'), line())
    rows.select(F.when(bucket == 0, short).when(bucket == 1, line(F.lit("more").alias("more"))).when(bucket == 2, opened).otherwise(line())) \
        .write.option("compression", "gzip").text(f"{root}/input")
    raw = read_raw_sales(spark, f"{root}/input", malformed=True, header=False, glob="*.txt.gz")
    counts = run_clean(spark, "", f"{root}/cleaned", f"{root}/quarantine", Q.RUN, raw=raw)
    kept = spark.read.parquet(f"{root}/quarantine").filter("quarantine_reason = 'malformed_record'").agg(
        F.count_if(F.col("malformed_record").isNotNull() & F.col("source_file").endswith(".txt.gz")).alias("traceable"))
    return kept.select("traceable", *(F.lit(n).cast("bigint").alias(c) for c, n in counts.items()))


def q_kpi_sink(spark: SparkSession, d: str) -> DataFrame:
    """A KPI table with its audit columns, written by (year, month) and read back."""
    base = scratch_path(spark, "kpi")
    Q.kpi_tables(spark, d, base)
    return read_kpi(spark, f"{base}/aggregated", "region_country_monthly")


def q_audit_dropped(spark: SparkSession, d: str) -> DataFrame:
    """The same table without its audit columns."""
    return drop_audit(q_kpi_sink(spark, d))


def q_report_sections(spark: SparkSession, d: str) -> DataFrame:
    return R.report_sections(_report(spark, d))


def q_top_products_nested(spark: SparkSession, d: str) -> DataFrame:
    from salesmart.operators.kpis import top_products_by_region
    return R.top_products_nested(top_products_by_region(Q.leading(spark, d)))


def q_manifest(spark: SparkSession, d: str) -> DataFrame:
    """K5's run, path, status and record counts (the size is in ``report_file``)."""
    m = R.manifest(_report(spark, d), Q.RUN_ID, Q.RUN_TS, "consolidated/2001/08/01/etl_report_fixture-run.json", 0)
    return m.select("run_id", "generated_at", "output_path", "status", "record_counts.*")


def _ingested(spark: SparkSession, d: str, after: Callable[[str], object] | None = None) -> str:
    """The table after two ingest runs over two file drops; ``after`` is called after each."""
    from salesmart.streaming import ingest_available
    root = scratch_path(spark, "stream")
    raw = Q.raw(spark, d).withColumn("dt", drop_of())
    inbox, cleaned, quar, ckpt = f"{root}/input", f"{root}/cleaned", f"{root}/quarantine", f"{root}/ckpt"
    for day in DROPS:
        write_raw_csv(raw.filter(F.col("dt") == day).drop("dt"), f"{inbox}/dt={day}", partition_by_dt=False, compression="gzip")
        ingest_available(spark, inbox, cleaned, quar, ckpt, schema=FIXTURE_RAW_SCHEMA, run_ts=Q.RUN_TS,
                         job=Q.JOB, ties=FIXTURE_TIES, glob=PACKED)
        if after:
            after(cleaned)
    return cleaned


def q_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """I1 + I2: two ingest runs over two file drops; the result must equal the batch job's table, its ``dt`` and
    audit columns included."""
    return read_cleaned(spark, _ingested(spark, d))


def _reuploaded(spark: SparkSession, d: str) -> str:
    """The folder of a table whose first drop came wrong and was uploaded again, with the second drop, under the same file names: the wrong
    one held every line of both, with another profit and a later date."""
    from salesmart.streaming import ingest_files
    root = scratch_path(spark, "ledger")
    raw = Q.raw(spark, d).withColumn("dt", drop_of())
    wrong = raw.withColumn("profit", F.lit("1.00")).withColumn("order_date", F.lit("2001-12-31"))
    files = Files(spark)
    for n, (first, second) in enumerate(((wrong, None), (raw.filter(F.col("dt") == DROPS[0]), raw.filter(F.col("dt") == DROPS[1])))):
        for day, rows in zip(DROPS, (first, second), strict=True):
            if rows is None:
                continue
            write_raw_csv(rows.drop("dt"), f"{root}/try{n}/dt={day}", partition_by_dt=False, compression="gzip")
            folder = f"{root}/input/dt={day}"
            for name in files.names(folder) if files.exists(folder) else []:
                files.delete(f"{folder}/{name}")
            for k, name in enumerate(sorted(x for x in files.names(f"{root}/try{n}/dt={day}") if x.endswith(".csv.gz"))):
                files.move(f"{root}/try{n}/dt={day}/{name}", f"{folder}/upload{k:05d}.csv.gz")
        ingest_files(spark, f"{root}/input", f"{root}/cleaned", f"{root}/quarantine", f"{root}/ledger", schema=FIXTURE_RAW_SCHEMA,
                     run_ts=Q.RUN_TS, job=Q.JOB, ties=FIXTURE_TIES, glob=PACKED)
    return root


def q_reuploaded_files(spark: SparkSession, d: str) -> DataFrame:
    """I1 + I2 by the file ledger: a drop that came wrong is replaced by its second upload; the result must equal the batch job's table."""
    return read_cleaned(spark, f"{_reuploaded(spark, d)}/cleaned")


def q_file_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the ledger counts in the files as they are now, and of those the quarantine's, by ingest day; nothing is left to do."""
    from salesmart.streaming import FileLedger, current_rejections
    root = _reuploaded(spark, d)
    ledger = FileLedger(spark, f"{root}/ledger")
    day = F.regexp_extract("file", "dt=([0-9-]+)", 1).alias("dt")
    read = ledger.current().groupBy(day).agg(F.sum("rows").alias("rows"))
    bad = current_rejections(spark, f"{root}/quarantine", f"{root}/ledger").groupBy(F.col("dt").cast("string").alias("dt")) \
        .agg(F.count(F.lit(1)).alias("rejected"))
    open_files = ledger.changes(f"{root}/input", PACKED).count()
    return read.join(bad, "dt", "left").select("dt", "rows", F.coalesce("rejected", F.lit(0).cast("long")).alias("rejected"),
                                               F.lit(open_files).cast("long").alias("open_files"))


def q_table_versions(spark: SparkSession, d: str) -> DataFrame:
    """Both versions that two drops left, as they count their committed files and as they read."""
    table = VersionedTable(spark, _ingested(spark, d))
    out = None
    for n in table.numbers():
        undated = table.version(n).months.get((None, None))
        one = table.read(n).agg(F.lit(n).alias("version"), F.lit(table.version(n).rows).cast("bigint").alias("counted_rows"),
                                F.lit(undated.rows if undated else 0).cast("bigint").alias("counted_undated"), F.count(F.lit(1)).alias("read_rows"),
                                F.count_if(F.col("order_date").isNull()).alias("read_undated"))
        out = one if out is None else out.unionByName(one)
    return out


def _refreshed(spark: SparkSession, d: str) -> str:
    """The KPI tables that followed the table through both drops."""
    base, limits = scratch_path(spark, "refreshed"), dict(high=Q.HIGH, mid=Q.MID, active=Q.ACTIVE, at_risk=Q.AT_RISK)
    _ingested(spark, d, lambda cleaned: refresh_aggregates(spark, cleaned, base, Q.RUN, as_of=Q.AS_OF, thresholds=limits))
    return base


#: dataset -> names, amount, count and figure that ``incremental_kpis`` shows of it
INCREMENTAL = {
    "region_country_monthly": (("region", "country"), "total_revenue", "total_orders", "profit_margin_pct"),
    "category_monthly": (("category", "sub_category"), "total_revenue", "total_orders", "avg_discount_pct"),
    "monthly_trend": (("region",), "monthly_revenue", "monthly_orders", "mom_growth_pct"),
    "top_products_by_region": (("region", "product_id"), "total_revenue", "rank_in_region", "avg_unit_price"),
    "customer_segments": (("customer_id", "region", "country", "customer_segment", "customer_status"), "lifetime_value", "total_orders", "avg_order_value"),
    "payment_distribution": (("payment_method", "region"), "total_revenue", "transaction_count", "avg_transaction_value"),
    "order_status_summary": (("status", "region"), "revenue_at_risk", "order_count", None),
}
DATED = ("region_country_monthly", "category_monthly", "monthly_trend", "payment_distribution", "order_status_summary")


def q_incremental_kpis(spark: SparkSession, d: str) -> DataFrame:
    """I2 -> A1-A7: the KPI tables that were brought up after each of two drops, not computed anew: names, an amount, a count and
    a figure of each row."""
    base, out = _refreshed(spark, d), None
    for name, (names, amount, count, figure) in INCREMENTAL.items():
        period = [F.col(c) if name in DATED else F.lit(None).cast("int").alias(c) for c in ("year", "month")]
        rows = read_kpi(spark, base, name).select(
            F.lit(name).alias("dataset"), F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("-")) for c in names)).alias("names"), *period,
            F.col(amount).cast("double").alias("amount"), F.col(count).cast("bigint").alias("n"),
            (F.col(figure) if figure else F.lit(None)).cast("double").alias("figure"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_incremental_overall(spark: SparkSession, d: str) -> DataFrame:
    """A8 from the months' sums and bitmaps, after two drops."""
    return drop_audit(read_kpi(spark, _refreshed(spark, d), "overall_kpi"))


def q_month_filters(spark: SparkSession, d: str) -> DataFrame:
    """Every month's key filter probed with every key of the table: a month finds all of its own keys, and few others."""
    path, key = scratch_path(spark, "keys"), ["order_id", "product_id"]
    Q.cleaned(spark, d).select(*key, "year", "month").write.parquet(path)
    rows = spark.read.parquet(path)
    counts = {(r.year, r.month): r["count"] for r in rows.groupBy("year", "month").count().collect()}     # bounded by the calendar
    filters = build_filters(with_blocks(rows, ["year", "month"], counts), ["year", "month"], key)
    own = rows.withColumnsRenamed({"year": "own_year", "month": "own_month"})
    found = probe(filters, own, ["year", "month"], key, [blocks_for(n) for n in counts.values()], carry=["own_year", "own_month"])
    mine = F.col("year").eqNullSafe(F.col("own_year")) & F.col("month").eqNullSafe(F.col("own_month"))
    hits = found.groupBy("year", "month").agg(F.count_if(mine).alias("found"), F.count_if(~mine).alias("others"))
    return hits.select("year", "month", "found", (F.col("others") <= F.lit(0.001 * sum(counts.values())) + 1).alias("few_others"))


def q_synth_sales(spark: SparkSession, d: str) -> DataFrame:
    """G1 + G2: one synthetic raw sale per lineitem key, plus 2 % dirty rows."""
    from salesmart.operators.synth import synth_sales, with_dirt
    ids = spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return with_dirt(synth_sales(ids))


def q_synth_undated(spark: SparkSession, d: str) -> DataFrame:
    """G2 through stage 1: the generator's rows with bad dates survive cleaning, undated."""
    undated = undated_rows(clean(q_synth_sales(spark, d)))
    return undated.agg(F.count(F.lit(1)).alias("undated_rows"))


IO_QUERIES = {
    "synth_undated": q_synth_undated,
    "synth_sales": q_synth_sales,
    "raw_scan": q_raw_scan,
    "cleaned_scan": q_cleaned_scan,
    "schema_drift": q_schema_drift,
    "catalog_changes": q_catalog_changes,
    "top_products_nested": q_top_products_nested,
    "report_sections": q_report_sections,
    "report_json": q_report_json,
    "report_json_values": q_report_json_values,
    "report_arrays": q_report_arrays,
    "report_file": q_report_file,
    "verify_report": q_verify_report,
    "quarantine_sink": q_quarantine_sink,
    "malformed_records": q_malformed_records,
    "kpi_sink": q_kpi_sink,
    "audit_dropped": q_audit_dropped,
    "manifest": q_manifest,
    "stream_ingest": q_stream_ingest,
    "reuploaded_files": q_reuploaded_files,
    "file_ledger": q_file_ledger,
    "table_versions": q_table_versions,
    "month_filters": q_month_filters,
    "incremental_kpis": q_incremental_kpis,
    "incremental_overall": q_incremental_overall,
}
