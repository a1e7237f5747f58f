"""Data quality and run accounting (V1-V3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import DEDUP_KEY, INVALID_NUMERIC, MALFORMED, MISSING_REQUIRED, QUALITY_OK, UNPARSEABLE_NUMERIC, UNREPRESENTABLE_AMOUNT
from salesmart.sinks.files import Files

QUALITY_CLASSES = (MALFORMED, MISSING_REQUIRED, INVALID_NUMERIC, UNPARSEABLE_NUMERIC, UNREPRESENTABLE_AMOUNT, QUALITY_OK)


def quality_metrics():
    """Aggregate expressions over a tagged frame: raw rows and one count per class."""
    return [F.count(F.lit(1)).alias("raw_rows")] + [
        F.count_if(F.col("quality") == c).alias(c if c != QUALITY_OK else "valid_rows") for c in QUALITY_CLASSES]


def observe_quality(tagged: DataFrame, name: str = "quality") -> tuple[DataFrame, Observation]:
    """Attach the V1 counters to a frame that is about to be written (no extra pass)."""
    obs = Observation(name)
    return tagged.observe(obs, *quality_metrics()), obs


def run_metrics(tagged: DataFrame, key: Sequence[str] = DEDUP_KEY) -> DataFrame:
    """V1 as a query: raw, per-class, clean, dropped duplicates and undated rows, one row.

    One pass over the class, the key and the date: a key's cleaned row is undated only if
    every valid version is, since undated versions rank last.
    """
    per_key = tagged.groupBy("quality", *key).agg(F.count(F.lit(1)).alias("n"), F.max("order_date").alias("latest"))
    of = lambda c: F.coalesce(F.sum(F.when(F.col("quality") == c, F.col("n"))), F.lit(0))
    ok = F.col("quality") == QUALITY_OK
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        *[of(c).alias(c if c != QUALITY_OK else "valid_rows") for c in QUALITY_CLASSES],
        F.count_if(ok).alias("clean_rows"), F.count_if(ok & F.col("latest").isNull()).alias("undated_rows"))
    return out.withColumn("duplicates_dropped", F.col("valid_rows") - F.col("clean_rows"))


def committed_counts(spark, staged: str, cleaned: str) -> dict:
    """V1 from what was committed: rows of every class in the tagged table, clean and undated rows in the cleaned one. Only footers
    and folder names are read, and a task that was run again counts once, since its lost files weren't committed."""
    tags = T.StructType([T.StructField("quality", T.StringType())])
    months = T.StructType([T.StructField(c, T.IntegerType()) for c in ("year", "month")])
    classes = {r["quality"]: r["count"] for r in _rows_by(spark, staged, tags)}
    periods = _rows_by(spark, cleaned, months)
    out = {"raw_rows": sum(classes.values())} | {c if c != QUALITY_OK else "valid_rows": classes.get(c, 0) for c in QUALITY_CLASSES}
    out["clean_rows"] = sum(r["count"] for r in periods)
    out["undated_rows"] = sum(r["count"] for r in periods if r["year"] is None)
    out["duplicates_dropped"] = out["valid_rows"] - out["clean_rows"]
    return out


def _rows_by(spark, path: str, parts: T.StructType) -> list:
    """Rows of every partition (bounded by the classes, or the calendar)."""
    if not any("=" in n for n in Files(spark).names(path)):
        return []
    return spark.read.schema(parts).parquet(path).groupBy(*parts.names).count().collect()


def reconciliation_summary(cleaned: DataFrame) -> DataFrame:
    """V2: cleaned rows per ``sales_amount_flag``."""
    return cleaned.groupBy("sales_amount_flag").agg(F.count(F.lit(1)).alias("row_count"))


def verify_report(spark, base: str, run_date) -> DataFrame:
    """V3: the run date's reports with their record counts; raises when there is none.

    Also checks each report's record counts against the manifest written beside it.
    """
    prefix = f"{base.rstrip('/')}/consolidated/{run_date:%Y/%m/%d}"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "etl_report_*.json").load(prefix).select("path", "length"))
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"no consolidated report under {prefix}")
    docs = spark.read.option("multiLine", "true").json(f"{prefix}/etl_report_*.json")
    mans = spark.read.option("multiLine", "true").json(f"{prefix}/manifest_*.json")
    d = docs.select(F.col("metadata.run_id").alias("run_id"), F.col("metadata.record_counts").alias("report_counts"))
    m = mans.select("run_id", "status", "file_size_bytes", F.col("record_counts").alias("manifest_counts"))
    sizes = files.select(F.regexp_extract("path", "etl_report_(.*)[.]json$", 1).alias("run_id"), "length")
    return d.join(m, "run_id", "left").join(sizes, "run_id", "left").select(
        "run_id", "report_counts", "status", "manifest_counts",
        (F.to_json("report_counts") == F.to_json("manifest_counts")).alias("counts_match"),
        (F.col("length") == F.col("file_size_bytes")).alias("size_matches"))
