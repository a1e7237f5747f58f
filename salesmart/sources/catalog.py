"""A catalog table that follows its files' headers, with a log of every change.

A run compares what the files hold now with the definition so far. A new column is appended, a type that no longer holds
the values is widened, a column that no file has any more stays (its rows read NULL) and is logged. The log is the
definition: it is written before the table is replaced, each run to its own partition, so a run that died in
between is repeated and changes nothing twice.

CSV rows are matched by position, so files of different headers can't share one scan. ``read_registered`` reads the files of each
header by that header and brings them together by column name.
"""

from __future__ import annotations

import csv
import datetime as _dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesmart.sinks.files import Files
from salesmart.sources.csv import infer_raw_schema

LOG = ("run_id string, run_ts timestamp, table_name string, column string, change string, "
       "old_type string, new_type string, position int")
CREATED, ADDED, WIDENED, REMOVED, RETURNED = "created", "added", "widened", "removed", "returned"
#: Each type holds every value of those before it in its row; two types of no common row meet in string.
WIDER = (("int", "bigint", "double", "string"), ("date", "timestamp", "string"), ("boolean", "string"))
_OPENERS = 32      # files whose first line is read at the same time


def wider(old: str, new: str) -> str:
    """The narrowest type of ``WIDER`` that holds both."""
    if old == new:
        return old
    for row in WIDER:
        if old in row and new in row:
            return row[max(row.index(old), row.index(new))]
    return "string"


def headers(spark: SparkSession, path: str, suffix: str = ".csv") -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header. One short read a file, side by side; no data is read."""
    files = Files(spark)
    paths = sorted(p for p in files.walk(path) if p.endswith(suffix) and files.size(p))
    with ThreadPoolExecutor(_OPENERS) as pool:
        lines = list(pool.map(files.first_line, paths))
    out: dict[tuple[str, ...], list[str]] = {}
    for p, line in zip(paths, lines, strict=True):
        out.setdefault(tuple(next(csv.reader([line]), ())), []).append(p)
    return out


def _scan(spark: SparkSession, path: str, header: Sequence[str], files: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(schema).option("header", "true").option("escape", '"').option("basePath", path).csv(files)


def _inferred(spark: SparkSession, path: str, groups: dict[tuple[str, ...], list[str]], sampling_ratio: float) -> dict[str, str]:
    """Column types over the files of all headers, in the order in which the columns first appear."""
    types: dict[str, str] = {}
    for header, files in sorted(groups.items(), key=lambda g: min(g[1])):
        found = infer_raw_schema(spark, files, sampling_ratio, base=path)
        for name, f in zip([*header, *found.names[len(header):]], found.fields, strict=True):
            kind = f.dataType.simpleString()
            kind = kind if any(kind in row for row in WIDER) else "double" if kind.startswith("decimal") else "timestamp" if "timestamp" in kind else "string"
            types[name] = wider(types[name], kind) if name in types else kind
    return types


def _misfits(spark: SparkSession, path: str, groups, columns: dict[str, str]) -> set[str]:
    """Which of ``columns`` hold a value that its type can't (a column without any value infers as string, and fits)."""
    out: set[str] = set()
    for header, files in groups.items():
        own = [c for c in columns if c in header]
        if own:
            row = _scan(spark, path, header, files).agg(*(F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(columns[c]).isNull())
                                                          .alias(str(k)) for k, c in enumerate(own))).first()
            out |= {c for k, c in enumerate(own) if row[k]}
    return out


def change_log(spark: SparkSession, log_path: str) -> DataFrame:
    """Every change so far, oldest first by ``run_ts``."""
    try:
        return spark.read.schema(LOG).parquet(log_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], LOG)
        raise


def definition(log: DataFrame, table: str) -> list[tuple[str, str, bool]]:
    """``column, type, present`` of the table by its log, in column order (bounded by the number of columns)."""
    last = Window.partitionBy("column").orderBy(F.desc("run_ts"), F.desc("run_id"))
    rows = log.filter(F.col("table_name") == table).withColumn("k", F.row_number().over(last)).filter("k = 1").orderBy("position").collect()
    return [(r["column"], r["new_type"], r["change"] != REMOVED) for r in rows]


def merge_definition(known: list[tuple[str, str, bool]], found: dict[str, str]) -> list[tuple[str, str, str | None, str, int]]:
    """Changes ``column, change, old_type, new_type, position`` that bring ``known`` to the columns found."""
    changes = []
    at = {name: k for k, (name, _, _) in enumerate(known)}
    for name, kind, present in known:
        if name not in found:
            if present:
                changes.append((name, REMOVED, kind, kind, at[name]))
        elif (to := wider(kind, found[name])) != kind:
            changes.append((name, WIDENED, kind, to, at[name]))
        elif not present:
            changes.append((name, RETURNED, kind, kind, at[name]))
    new = [c for c in found if c not in at]
    return changes + [(c, ADDED if known else CREATED, None, found[c], len(known) + k) for k, c in enumerate(new)]


def update_table(spark: SparkSession, path: str, table: str, log_path: str, run_id: str, run_ts: _dt.datetime,
                 sampling_ratio: float = 1.0) -> DataFrame:
    """Register the CSV folder as ``table``, or bring its definition up to the files; this run's rows of the log."""
    log = change_log(spark, log_path)
    known = definition(log.filter(F.col("run_id") != run_id), table)
    if not known and spark.catalog.tableExists(table):      # registered before there was a log
        known = [(f.name, f.dataType.simpleString(), True) for f in spark.table(table).schema.fields]
    groups = headers(spark, path)
    found = _inferred(spark, path, groups, sampling_ratio)
    doubted = {c: kind for c, kind, _ in known if found.get(c) == "string" and kind != "string"}
    for c in set(doubted) - _misfits(spark, path, groups, doubted):
        found[c] = doubted[c]
    changes = [(run_id, run_ts, table, *c) for c in merge_definition(known, found)]
    rows = spark.createDataFrame(changes, LOG)
    if changes:
        rows.coalesce(1).withColumn("run", F.col("run_id")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(log_path)
    now = definition(change_log(spark, log_path), table)
    schema = T.StructType([T.StructField(c, T.StructType.fromDDL(f"x {kind}")[0].dataType) for c, kind, _ in now])
    if now and (not spark.catalog.tableExists(table) or spark.table(table).schema != schema):
        spark.sql(f"DROP TABLE IF EXISTS {table}")      # external: the files stay, and the log has the definition
        spark.catalog.createTable(table, path=path, source="csv", schema=schema, header="true", escape='"', pathGlobFilter="*.csv")
    return rows


def read_registered(spark: SparkSession, path: str, table: str, log_path: str) -> DataFrame:
    """The folder's rows with the registered columns and types, whatever header their file has; a value that a later
    type can't hold, or a column that a file lacks, is NULL."""
    now = definition(change_log(spark, log_path), table)
    out = None
    for header, files in sorted(headers(spark, path).items()):
        rows = _scan(spark, path, header, files)
        rows = rows.select(*(F.col(f"`{c}`").try_cast(kind).alias(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind, _ in now))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` {kind}" for c, kind, _ in now))
    return out
