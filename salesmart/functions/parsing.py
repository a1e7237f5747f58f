"""Lenient text -> typed value parsing that never raises, whatever ``spark.sql.ansi.enabled`` is.

The original pipeline relied on non-ANSI casts turning bad text into NULL; Spark 4 raises
instead, so every conversion here is a ``try_`` form.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schema import DATE_FORMATS, MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize(c) -> Column:
    """Trim spaces (U+0020 only, as ``trim`` does) and turn blank text into NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


# digits with an optional sign and fraction: what the lenient text-to-integer cast reads
PLAIN_NUMBER = r"^[\x00-\x20]*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)[\x00-\x20]*$"


def lenient_int(c) -> Column:
    """Text -> INT, truncating a fraction ('2.5' -> 2) as the lenient cast did.

    Exponents, type suffixes ('1e2', '5D'), non-finite and out-of-range numbers give NULL.
    """
    return F.when(_col(c).rlike(PLAIN_NUMBER), _col(c).try_cast("double").try_cast("int"))


def finite(c) -> Column:
    """Text -> DOUBLE; text that is no number, 'NaN' and 'Infinity' give NULL."""
    d = _col(c).try_cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def money(c, dtype=MONEY) -> Column:
    """Text -> exact DECIMAL; NULL for text that is no finite number, and for one that ``dtype`` can't hold."""
    return F.coalesce(_col(c).try_cast(dtype), finite(c).try_cast(dtype))


def unrepresentable(cols: Sequence[str], dtype=MONEY) -> Column:
    """Whether any of the texts is a finite number with more integer digits than ``dtype`` holds.

    One small lambda over an array: five more casts spelled out would take the cleaning projection
    past the size that Java compiles.
    """
    limit = 10.0 ** (dtype.precision - dtype.scale)
    return F.coalesce(F.exists(F.array(*cols), lambda c: F.abs(c.try_cast("double")).between(limit, sys.float_info.max)),
                      F.lit(False))


def layout_regex(fmt: str) -> str:
    """Digit shape of a date layout: 'yyyy' -> 4 digits, 'MM'/'dd' -> 2 digits, rest literal."""
    out, i = "^", 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        out += f"\\d{{{j - i}}}" if ch in "yMd" else re.escape(fmt[i:j])
        i = j
    return out + "$"


def parse_date(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that parses wins; text matching none gives NULL (the row is kept).

    Each layout is tried only on text of its exact digit shape (two-digit day and month,
    four-digit year, as the strict parser requires), so a value costs one regex test per
    layout and at most one real parse, instead of a failing parse per layout.
    """
    c = _col(c)
    return F.coalesce(*[F.when(c.rlike(layout_regex(f)), F.try_to_timestamp(c, F.lit(f))) for f in formats])
