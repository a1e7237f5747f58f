"""Stage 1: raw text -> tagged rows -> cleaned fact and quarantine.

One pass tags every raw row with exactly one quality class, so that
``raw = clean + duplicates + malformed_record + missing_required_field + invalid_numeric + unparseable_numeric +
unrepresentable_amount`` always holds (malformed records are told apart where the scan was asked to; the original lost rows whose numbers did not parse). Every step is row-local
except ``dedup_latest``, which shuffles by the natural key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.parsing import (
    finite, lenient_int, money, parse_date, standardize, unrepresentable,
)
from salesmart.operators.windows import dedup_latest
from salesmart.schema import (
    DATE_COLUMNS, DEDUP_KEY, FILE_COLUMN, FLAG_MISMATCH, FLAG_OK, INVALID_NUMERIC, MALFORMED, MALFORMED_COLUMN, MISMATCH_TOLERANCE,
    MISSING_REQUIRED, MONEY, MONEY_COLUMNS, QUALITY_OK, QUARANTINE_COLUMNS, REQUIRED_FIELDS,
    UNPARSEABLE_NUMERIC, UNREPRESENTABLE_AMOUNT,
)

QUALITY = "quality"
AMOUNTS = ("discount", *MONEY_COLUMNS)
RECONCILED = ("sales_amount_calc", "sales_amount_flag")     # what P5 and P6 add


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every STRING column (chosen by schema type)."""
    s = set(_string_columns(df))
    return df.select([F.trim(F.col(c)).alias(c) if c in s else F.col(c) for c in df.columns])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Blank STRING values -> NULL."""
    s = set(_string_columns(df))
    return df.select([F.nullif(F.col(c), F.lit("")).alias(c) if c in s else F.col(c) for c in df.columns])


def standardize_text(df: DataFrame) -> DataFrame:
    """P1 + P2 in one projection (a malformed line's text and a file's name stay as they are)."""
    s = set(_string_columns(df)) - {MALFORMED_COLUMN, FILE_COLUMN}
    return df.select([standardize(c).alias(c) if c in s else F.col(c) for c in df.columns])


def required(fields: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """every required field present (never NULL itself)."""
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields])


def valid_required(df: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    return df.filter(required(fields))


def missing_required(df: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """F2."""
    return df.filter(~required(fields))


def cast_numeric(df: DataFrame) -> DataFrame:
    """Quantity -> INT (fraction truncated), money -> DECIMAL(24,6), discount too."""
    conv = {"quantity": lenient_int, **{c: money for c in AMOUNTS}}
    return df.select([conv[c](c).alias(c) if c in conv else F.col(c) for c in df.columns])


def parse_dates(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Multi-layout date text -> TIMESTAMP (midnight, session zone); no match -> NULL."""
    cols = set(cols)
    return df.select([parse_date(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def invalid_numeric_cond() -> Column:
    """three-valued ``quantity <= 0 OR unit_price <= 0``."""
    return (F.col("quantity") <= 0) | (F.col("unit_price") <= 0)


def valid_numeric_cond() -> Column:
    """three-valued ``quantity > 0 AND unit_price > 0``."""
    return (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def invalid_numeric(df: DataFrame) -> DataFrame:
    return df.filter(invalid_numeric_cond())


def valid_numeric(df: DataFrame) -> DataFrame:
    return df.filter(valid_numeric_cond())


def unparseable_numeric(df: DataFrame) -> DataFrame:
    """rows matching neither F3 nor F4 (a number did not parse)."""
    return df.filter(~F.coalesce(invalid_numeric_cond(), F.lit(False))
                     & ~F.coalesce(valid_numeric_cond(), F.lit(False)))


def recalc_sales(df: DataFrame) -> DataFrame:
    """P5: ``sales_amount_calc = round(quantity * unit_price * (1 - coalesce(discount, 0)), 2)``."""
    # the product keeps six decimals before it is rounded to cents; one that DECIMAL(38) can't hold is NULL
    share = F.lit(Decimal(1)) - F.coalesce(F.col("discount"), F.lit(Decimal(0)).cast(MONEY))
    return df.withColumn("sales_amount_calc", F.round(F.try_multiply(F.col("quantity") * F.col("unit_price"), share), 2))


def flag_sales(df: DataFrame, tol: str = MISMATCH_TOLERANCE) -> DataFrame:
    """MISMATCH when ``|sales_amount - calc| / calc > tol``.

    Written without a division: a zero, negative or NULL ``calc`` or a NULL ``sales_amount``
    gives OK, exactly as the ratio form does under NULL-on-divide-by-zero.
    """
    calc = F.col("sales_amount_calc")
    bad = (calc > 0) & (F.abs(F.col("sales_amount") - calc) > F.try_multiply(calc, F.lit(tol).cast("decimal(10,4)")))
    return df.withColumn("sales_amount_flag", F.when(bad, F.lit(FLAG_MISMATCH)).otherwise(F.lit(FLAG_OK)))


def with_period(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """``year``, ``month`` of the order date (NULL for undated rows)."""
    return df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))


def with_audit(df: DataFrame, job: str, run_ts, ts_col: str = "etl_ts") -> DataFrame:
    """Audit columns; ``run_ts`` is one literal per run, shared by every table."""
    return df.withColumn("etl_job", F.lit(job)).withColumn(ts_col, F.lit(run_ts).cast("timestamp"))


def drop_audit(df: DataFrame, cols: Sequence[str] = ("etl_job", "etl_ts", "etl_processed_at", "generated_at")) -> DataFrame:
    """Drop audit/helper columns that are present (absent ones are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def quality_expr(has_required: Column | None = None, malformed: Column | None = None) -> Column:
    """P10: the quality class of a standardized text row (one ``when`` chain).

    Required fields are checked on the text, before parsing, as the original did: an
    unparseable date keeps its row (undated) while an unparseable number is tagged. Signs are
    judged on the number as written, not on what the stored type keeps of it.
    """
    has_required = required() if has_required is None else has_required
    q, p = lenient_int("quantity"), finite("unit_price")
    first = F.when(~has_required, F.lit(MISSING_REQUIRED)) if malformed is None else \
        F.when(malformed, F.lit(MALFORMED)).when(~has_required, F.lit(MISSING_REQUIRED))
    return (first
            .when((q <= 0) | (p <= 0), F.lit(INVALID_NUMERIC))
            .when((q > 0) & (p > 0) & unrepresentable(AMOUNTS), F.lit(UNREPRESENTABLE_AMOUNT))
            .when((q > 0) & (p > 0), F.lit(QUALITY_OK))
            .otherwise(F.lit(UNPARSEABLE_NUMERIC)))


def with_quality(raw: DataFrame) -> DataFrame:
    """Standardized text with a ``quality`` tag.

    The tag bears a condition on the partition's number, which always holds: a column that isn't deterministic keeps
    Catalyst from pushing filters on it below the projections that made its text, where every
    use of a column would compute it anew (raw text made by expressions was rendered some ten times a row).
    """
    malformed = F.col(MALFORMED_COLUMN).isNotNull() if MALFORMED_COLUMN in raw.columns else None
    tag = F.when(F.spark_partition_id() >= 0, quality_expr(malformed=malformed))
    return standardize_text(raw).withColumn(QUALITY, tag)


def type_rows(std: DataFrame) -> DataFrame:
    """P3-P6 over standardized text."""
    return flag_sales(recalc_sales(parse_dates(cast_numeric(std))))


def tag_quality(raw: DataFrame) -> DataFrame:
    """P1-P6 + P10 in one pass: standardized, typed rows with a ``quality`` tag."""
    return type_rows(with_quality(raw))


def valid_rows(tagged: DataFrame) -> DataFrame:
    """The rows of class ``ok``, without the columns that only rejected rows need."""
    return tagged.filter(F.col(QUALITY) == QUALITY_OK).drop(QUALITY, MALFORMED_COLUMN, FILE_COLUMN)


def clean(raw: DataFrame, key: Sequence[str] = DEDUP_KEY, ties: Sequence[str] = (),
          tagged: DataFrame | None = None) -> DataFrame:
    """Cleaned fact: valid rows, latest version per natural key, with ``year``/``month``.

    P5 and P6 follow from columns that the dedup's order has anyway, so they are computed for the rows that stay and
    neither sorted nor shuffled.
    """
    t = tag_quality(raw) if tagged is None else tagged
    kept = dedup_latest(valid_rows(t).drop(*RECONCILED), key, "order_date", ties)
    return with_period(flag_sales(recalc_sales(kept)))


def default_run_ts() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def quarantine(raw: DataFrame, run_ts=None, full: bool = True) -> DataFrame:
    """Every rejected row with its reason and the run timestamp.

    The original's three columns come first; ``full`` appends the standardized raw text so
    that a record stays traceable when ``order_id`` itself was the missing field.
    """
    return rejected(with_quality(raw), run_ts, full)


def rejected(std: DataFrame, run_ts=None, full: bool = True) -> DataFrame:
    """The same from rows that ``with_quality`` tagged."""
    run_ts = run_ts or default_run_ts()
    q = std.filter(F.col(QUALITY) != QUALITY_OK)
    head = [F.col("order_id"), F.col(QUALITY).alias("quarantine_reason"),
            F.lit(run_ts).cast("timestamp").alias("quarantine_ts")]
    rest = [c for c in std.columns if c not in (*QUARANTINE_COLUMNS, QUALITY)] if full else []
    return q.select(*head, *rest)


def undated_rows(cleaned: DataFrame) -> DataFrame:
    """cleaned rows whose order date did not parse."""
    return cleaned.filter(F.col("order_date").isNull())
