"""What the operators share: reading tables, tables in the shared folder, Arrow batch helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.session import checkpoint_root, scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows an Arrow batch holds at most. Texts run to some 100 KB, so Spark's default of 10,000
#: rows could put a gigabyte into one batch of a Python worker.
ARROW_ROWS = 512


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application, for those that don't have it installed."""
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="salesmart-code-"), "salesmart.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)     # Spark's own file server hands it to the executors
    _shipped.add(app)


def prepare(spark: SparkSession) -> None:
    """Session settings that bound a Python worker's memory and keep joins safe under skew."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: one computation for several
    readers, and lineage that a lost executor can't break. ``release`` removes the folders."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{spark.sparkContext.applicationId}/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for files that an operator writes itself."""
    return scratch_path(spark, f"llm-{spark.sparkContext.applicationId}/{name}")


def release(spark: SparkSession) -> None:
    """Remove every table and archive this application's operators left in the shared folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_root(spark).rstrip('/')}/salesmart/llm-{spark.sparkContext.applicationId}")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def whole(text: Column | str) -> Column:
    """A text with null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """One Arrow batch in, one out; the columns come as c0, c1, ... (a name with a dot would be taken for a field)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(fn, batches)
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))).mapInArrow(run, schema)
