"""Raw sales text: scan (S1, S2), catalog registration and schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import FILE_COLUMN, MALFORMED_COLUMN, RAW_SCHEMA


def read_raw_sales(spark: SparkSession, path: str | list[str], *, header_check: bool = False, schema: T.StructType = RAW_SCHEMA,
                   glob: str = "*.csv", malformed: bool = False, header: bool = True, base: str | None = None) -> DataFrame:
    """All-STRING CSV scan of ``path`` and the partition folders below it.

    Header line skipped; fields matched by position (short rows padded with NULL, extra
    fields dropped). ``header_check=True`` makes Spark compare the header with the schema
    and fail on a reordered file. Hive-style folders (``dt=YYYY-MM-DD``) become columns; ``base`` is the folder above
    them when ``path`` lists files.

    ``malformed=True`` adds the text of each line whose fields are too few or too many, which ``tag_quality`` makes a class of its own, and
    every line's file. An open quote takes the rest of its line, so it shows as too few fields; in the last field
    nothing is lost but the quote mark, and the line is well formed. Such a scan parses all columns, whichever are used.
    """
    reader = (spark.read.schema(T.StructType([*schema.fields, T.StructField(MALFORMED_COLUMN, T.StringType())]) if malformed else schema)
              .option("header", str(header).lower())
              .option("multiLine", "false")
              .option("escape", '"')
              .option("mode", "PERMISSIVE")
              .option("enforceSchema", "false" if header_check else "true")
              .option("pathGlobFilter", glob))
    if base:
        reader = reader.option("basePath", base)
    if not malformed:
        return reader.csv(path)
    rows = reader.option("columnNameOfCorruptRecord", MALFORMED_COLUMN).option("columnPruning", "false").csv(path)
    return rows.withColumn(FILE_COLUMN, F.col("_metadata.file_path"))


def infer_raw_schema(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0,
                     glob: str = "*.csv", base: str | None = None) -> T.StructType:
    """Types a crawler would infer from the text (``samplingRatio`` bounds the scan); ``base`` is the folder whose
    ``key=value`` subfolders become columns when ``path`` lists files."""
    reader = (spark.read.option("header", "true").option("inferSchema", "true")
              .option("samplingRatio", str(sampling_ratio)).option("escape", '"').option("pathGlobFilter", glob))
    return (reader.option("basePath", base) if base else reader).csv(path).schema


def register_raw(spark: SparkSession, path: str, table: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Register the raw folder as an external catalog table with inferred types, once; ``catalog.update_table``
    registers it and keeps it up to changed files."""
    schema = infer_raw_schema(spark, path, sampling_ratio)
    spark.catalog.createTable(table, path=path, source="csv", schema=schema, header="true",
                              escape='"', pathGlobFilter="*.csv")
    return spark.table(table)


def _schema_frame(spark: SparkSession, schema: T.StructType, type_col: str) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, f"pos int, column string, {type_col} string")


def schema_drift(spark: SparkSession, expected: T.StructType, inferred: T.StructType) -> DataFrame:
    """One row per column of either schema with its change (added/removed/type_changed/unchanged).

    Both inputs are schemas (bounded by the column count), compared with a full outer join.
    """
    e = _schema_frame(spark, expected, "expected_type").withColumnRenamed("pos", "expected_pos")
    i = _schema_frame(spark, inferred, "inferred_type").withColumnRenamed("pos", "inferred_pos")
    j = e.join(i, "column", "full_outer")
    change = (F.when(F.col("expected_type").isNull(), F.lit("added"))
              .when(F.col("inferred_type").isNull(), F.lit("removed"))
              .when(F.col("expected_type") != F.col("inferred_type"), F.lit("type_changed"))
              .otherwise(F.lit("unchanged")))
    return j.select("column", "expected_type", "inferred_type", change.alias("change"),
                    F.coalesce("inferred_pos", "expected_pos").alias("position"))
