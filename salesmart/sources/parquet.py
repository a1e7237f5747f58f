"""Parquet readers (S3, S4) and the shared-input cache."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sinks.versions import VersionedTable


def read_cleaned(spark: SparkSession, path: str, periods: Iterable[tuple[int, int]] | None = None,
                 version: int | None = None) -> DataFrame:
    """S3: the cleaned table; ``periods`` [(year, month), ...] prunes partitions at the scan. A table that has versions (the
    incremental path writes them) is read as of its current one, or of ``version``."""
    table = VersionedTable(spark, path)
    if version is not None or table.numbers():
        return table.read(version, periods or None)
    df = spark.read.parquet(path)
    if periods:
        cond = None
        for y, m in periods:
            c = (F.col("year") == y) & (F.col("month") == m)
            cond = c if cond is None else cond | c
        df = df.filter(cond)
    return df


def read_kpi(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A named KPI table ``{base}/{name}``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}")


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist an input shared by several actions, materialise it once, release it after.

    Lost blocks (a lost executor) are recomputed from lineage, so this is safe to use on a
    cluster; select the needed columns first so the cache holds only those.
    """
    df = df.persist(level)
    try:
        df.count()
        yield df
    finally:
        df.unpersist()
