"""Report assembly (N1-N4): the KPI sections as one nested row, built on the executors.

Every section is bounded by dimension sizes (regions x countries, months x regions, the
products that rank among the first ten of a region, ties included), never by fact rows. The sections are stacked with one
``unionByName`` (each row carries exactly one section) and folded by a single global
aggregate into one row: no driver loop, no ``collect``, no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import to_edge
from salesmart.operators.clean import drop_audit
from salesmart.schema import UNKNOWN_KEY

# sections of the report in document order, with their array order: (column, "asc"|"desc")
SECTION_ORDER: dict[str, list[tuple[str, str]]] = {
    "regional_summary": [("total_revenue", "desc")],
    "category_summary": [("category", "asc"), ("total_revenue", "desc")],
    "monthly_trends": [("year", "asc"), ("month", "asc"), ("region", "asc")],
    "customer_segments": [("customer_segment", "asc"), ("customer_status", "asc")],
    "payment_distribution": [("region", "asc"), ("total_revenue", "desc")],
    "order_status_summary": [("region", "asc"), ("status", "asc")],
}
RECORD_COUNT_FIELDS = {
    "regional_rows": "regional_summary", "category_rows": "category_summary",
    "monthly_trend_rows": "monthly_trends", "top_product_rows": "top_products",
    "customer_rows": "customer_segments", "payment_rows": "payment_distribution",
    "status_rows": "order_status_summary",
}
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}


def _sort_key(order: Sequence[tuple[str, str]]) -> Column:
    """Struct whose ascending order is the requested order (desc numbers: NULLs last)."""
    fields = []
    for i, (c, how) in enumerate(order):
        if how == "desc":
            fields += [F.col(c).isNull().alias(f"n{i}"), (-F.col(c)).alias(f"k{i}")]
        else:
            fields.append(F.col(c).alias(f"k{i}"))
    return F.struct(*fields)


def section_rows(df: DataFrame, name: str, order: Sequence[tuple[str, str]]) -> DataFrame:
    """N2 input: one column ``name`` holding struct(sort key, row without audit columns)."""
    df = to_edge(drop_audit(df))
    return df.select(F.struct(_sort_key(order).alias("k"), F.struct(*df.columns).alias("v")).alias(name))


def sorted_section(name: str) -> Column:
    """The collected rows of a section as an ordered array (ties broken by the whole row)."""
    return F.transform(F.sort_array(F.collect_list(name)), lambda x: x["v"])


def top_products_entries(a4: DataFrame) -> DataFrame:
    """N1 input: (region key, rank-ordered product array) per region; NULL region -> 'UNKNOWN'."""
    df = to_edge(drop_audit(a4))
    per_region = df.groupBy(F.coalesce(F.col("region"), F.lit(UNKNOWN_KEY)).alias("key")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("rank_in_region").alias("k"),
                                                         F.struct(*df.columns).alias("v")))),
                    lambda x: x["v"]).alias("value"))
    return per_region.select(F.struct("key", "value").alias("top_products"))


def top_products_nested(a4: DataFrame) -> DataFrame:
    """N1 in flat form: region key, product count and first product of each region's list."""
    e = top_products_entries(a4).select("top_products.*")
    return e.select(F.col("key").alias("region"), F.size("value").cast("bigint").alias("product_count"),
                    F.col("value")[0]["product_id"].alias("first_product"))


def segment_entries(seg_totals: DataFrame) -> DataFrame:
    """N4 input: (segment, count) entries; NULL segment -> 'UNKNOWN'."""
    return seg_totals.select(F.struct(F.coalesce(F.col("customer_segment"), F.lit(UNKNOWN_KEY)).alias("key"),
                                      F.col("count").alias("value")).alias("segment_totals"))


def build_report(sections: dict[str, DataFrame], run_id: str, run_ts, job: str) -> DataFrame:
    """One row with column ``report`` (nested struct) from the stage-3 sections.

    ``sections`` holds ``overall_kpi`` (A8), the six list sections of ``SECTION_ORDER``,
    ``top_products`` (A4) and ``segment_totals`` (B6).
    """
    # the KPI section keeps its own ``generated_at``; only the job columns are dropped
    kpi = to_edge(drop_audit(sections["overall_kpi"], ("etl_job", "etl_ts")))
    parts = [kpi.select(F.struct(*kpi.columns).alias("overall_kpi"))]
    parts += [section_rows(sections[n], n, o) for n, o in SECTION_ORDER.items()]
    parts += [top_products_entries(sections["top_products"]), segment_entries(sections["segment_totals"])]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)

    folded = stacked.agg(
        F.any_value("overall_kpi", ignoreNulls=True).alias("overall_kpi"),
        *[sorted_section(n).alias(n) for n in SECTION_ORDER],
        F.map_from_entries(F.sort_array(F.collect_list("top_products"))).alias("top_products"),
        F.map_from_entries(F.sort_array(F.collect_list("segment_totals"))).alias("segment_totals"),
    )
    n_top = F.aggregate(F.map_values("top_products"), F.lit(0), lambda acc, x: acc + F.size(x))
    counts = F.struct(*[
        (n_top if sec == "top_products" else F.size(sec)).alias(field) for field, sec in RECORD_COUNT_FIELDS.items()])
    metadata = F.struct(
        F.lit(run_id).alias("run_id"),
        F.lit(_iso(run_ts)).alias("generated_at"),
        F.lit(job).alias("etl_job"),
        F.struct(F.col("overall_kpi.data_from").alias("from"), F.col("overall_kpi.data_to").alias("to")).alias("data_range"),
        counts.alias("record_counts"),
        F.col("segment_totals").alias("customer_segment_totals"),
    )
    return folded.select(F.struct(
        metadata.alias("metadata"), "overall_kpi", "regional_summary", "category_summary", "monthly_trends",
        "top_products", "customer_segments", "payment_distribution", "order_status_summary",
    ).alias("report"))


def _iso(ts) -> str:
    return ts.isoformat() if hasattr(ts, "isoformat") else str(ts)


def report_json(report: DataFrame, pretty: bool = True) -> DataFrame:
    """K4 body: the report row as JSON text (NULL fields kept, ISO timestamps)."""
    opts = dict(JSON_OPTIONS, pretty="true" if pretty else "false")
    return report.select(F.to_json("report", opts).alias("json"))


def report_sections(report: DataFrame) -> DataFrame:
    """(section, rows) of a built report, one row per list section."""
    m = F.col("report.metadata.record_counts")
    return report.select(F.inline(F.array(*[
        F.struct(F.lit(sec).alias("section"), m[field].cast("bigint").alias("rows"))
        for field, sec in RECORD_COUNT_FIELDS.items()])))


def manifest(report: DataFrame, run_id: str, run_ts, output_path: str, file_size: int,
             status: str = "SUCCESS") -> DataFrame:
    """K5/V4: run id, time, report path, the written file's size in bytes, status and record counts."""
    body = report_json(report)
    return body.select(
        F.lit(run_id).alias("run_id"), F.lit(_iso(run_ts)).alias("generated_at"),
        F.lit(output_path).alias("output_path"), F.lit(file_size).cast("bigint").alias("file_size_bytes"),
        F.lit(status).alias("status"),
        F.from_json("json", "struct<metadata:struct<record_counts:struct<regional_rows:int,category_rows:int,"
                    "monthly_trend_rows:int,top_product_rows:int,customer_rows:int,payment_rows:int,"
                    "status_rows:int>>>")["metadata"]["record_counts"].alias("record_counts"))
