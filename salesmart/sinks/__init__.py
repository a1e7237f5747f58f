"""Writers (K1-K5). Every write goes through Spark's committer, so a lost task is retried
and a failed job leaves no partial files in the target partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import KPI_MAX_FILES, KPI_WRITERS
from salesmart.sinks.files import single_file


def write_cleaned(df: DataFrame, path: str, files: int | None = None) -> None:
    """K1: cleaned fact, hive-partitioned by (year, month), full overwrite.

    Rows are rebalanced by (year, month) before the write: AQE splits a big month into
    several advisory-sized tasks and merges small ones, instead of the fixed 20 hash
    partitions that put each month in a single task. ``files`` forces a fixed count.
    """
    write_months(df.repartition(files, "year", "month") if files else df.hint("rebalance", "year", "month"), path)


def write_months(df: DataFrame, path: str) -> None:
    """``write_cleaned`` of rows that are dealt to tasks already; packed well, as stage 2 reads them several times."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
       .partitionBy("year", "month").parquet(path))


def write_quarantine(df: DataFrame, path: str, run_id: str) -> None:
    """K2: rejected rows under ``run_id=<id>``; a rerun of the same run replaces only its partition.

    The rejected rows are a small share of the input but come from every input split; a
    rebalance (a shuffle of just these rows) turns them into a few sized files instead of
    one small file per split.
    """
    (df.withColumn("run_id", F.lit(run_id)).hint("rebalance").write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def write_kpi(df: DataFrame, base: str, name: str, partitions: tuple[str, ...] = (), bounded: bool = True,
              mode: str = "static") -> str:
    """K3: a KPI table at ``{base}/{name}``, at most ``KPI_MAX_FILES`` files per output partition. ``mode="dynamic"``
    replaces only the output partitions that ``df`` has rows of.

    * partitioned, dimension-bounded tables: rows are hash-partitioned on the partition
      columns (a shuffle of the small result), so each (year, month) gets exactly one file;
      the number of tasks is given, as AQE would put so few bytes, and every folder, into one task;
    * unpartitioned bounded tables: ``coalesce`` to at most ``KPI_MAX_FILES`` tasks;
    * tables that grow with the data (one row per customer): ``rebalance``, so the final
      aggregation stays fully parallel and AQE sizes the files (``coalesce`` would narrow
      the stage that computes them).
    """
    path = f"{base.rstrip('/')}/{name}"
    if not bounded:
        out = df.hint("rebalance")
    elif partitions:
        tasks = min(df.sparkSession.sparkContext.defaultParallelism, KPI_WRITERS)
        out = df.repartition(max(tasks, 1), *partitions)
    else:
        out = df.coalesce(KPI_MAX_FILES)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", mode)
    if partitions:
        w = w.partitionBy(*partitions)
    w.parquet(path)
    return path


def report_path(base: str, run_date, run_id: str, kind: str = "etl_report") -> str:
    return f"{base.rstrip('/')}/consolidated/{run_date:%Y/%m/%d}/{kind}_{run_id}.json"


def write_json_text(json_df: DataFrame, path: str) -> int:
    """K4/K5: a one-row JSON text (bounded: one document) as the file ``path``; its size in bytes."""
    return single_file(json_df.sparkSession, json_df.select("json"), path)
