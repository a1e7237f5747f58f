"""The one place where money is summed, averaged and rounded.

Rules (chosen so that results do not depend on partitioning or evaluation order):

* row money is DECIMAL, so every sum is exact;
* a total is ``round(sum(x), 2)`` kept as DECIMAL(38,2);
* a mean is ``double(sum(x)) / count(x)`` and a ratio ``double(sum(a)) / double(sum(b))``,
  each rounded half-up to 2 places; a zero or NULL divisor gives NULL (``try_divide``);
* re-aggregating stored 2-dp values first casts them back to DECIMAL (exact), so a mean of
  means is computed from an exact sum;
* DOUBLE appears only at the edge (``to_edge``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import TOTAL


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(x) -> Column:
    return F.round(_col(x), 2)


def total2(c) -> Column:
    """Exact money total rounded to cents."""
    return F.round(F.sum(_col(c)), 2).cast(TOTAL)


def exact(c) -> Column:
    """A stored 2-dp DOUBLE back to an exact DECIMAL (no-op for DECIMAL input)."""
    return _col(c).cast(TOTAL)


def mean2(c) -> Column:
    """Mean of a DECIMAL (or exact) column, rounded to 2 places, DOUBLE."""
    c = _col(c)
    return F.round(F.try_divide(F.sum(c).cast("double"), F.count(c)), 2)


def mean_of_means2(c) -> Column:
    """Unweighted mean of stored 2-dp means, from an exact sum."""
    return mean2(exact(c))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_pct(a: Column, b: Column) -> Column:
    """``round(a / b * 100, 2)`` with a NULL for a zero divisor."""
    return F.round(ratio(a, b) * 100, 2)


def to_edge(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE for consumers outside the mart (reports, checks)."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
