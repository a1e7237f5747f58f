"""Window operators: keep-latest dedup, month-over-month growth, top-N per group.

All three filter on a ranking function right above the window, which Catalyst turns into
a ``WindowGroupLimit`` that also runs *before* the shuffle, so a hot key is cut down to a
few rows per map partition instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import ratio_pct

RANK_METHODS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def dedup_latest(df: DataFrame, key: Sequence[str], order_col: str, ties: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``key``: greatest ``order_col`` (NULL last), then ``ties`` ascending.

    Every other column follows ``ties`` (schema order, ascending, NULL first), so the winner
    is deterministic under any partitioning (the original left ties to chance).
    """
    key = _names(key)
    ties = tie_order(df.columns, key, order_col, ties)
    w = Window.partitionBy(*key).orderBy(
        F.col(order_col).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def tie_order(columns: Sequence[str], key: Sequence[str], order_col: str, ties: Sequence[str] = ()) -> list[str]:
    """Full tie-break list of ``dedup_latest``: ``ties`` then the remaining columns."""
    ties = [c for c in ties if c in columns]
    return ties + [c for c in columns if c not in key and c != order_col and c not in ties]


def top_n_per_group(df: DataFrame, part: Sequence[str] | str, order: Sequence[Column], n: int,
                    method: str = "rank", rank_col: str = "rank") -> DataFrame:
    """Rows whose rank within ``part`` is at most ``n``; ``rank`` keeps ties (may exceed n rows).

    ``row_number`` cuts through ties, so the remaining columns are appended to the order
    (ascending): the kept rows are then the same under any partitioning.
    """
    fn = RANK_METHODS[method]
    if method == "row_number":
        order = list(order) + [F.col(c).asc_nulls_first() for c in df.columns if c not in _names(part)]
    w = Window.partitionBy(*_names(part)).orderBy(*order)
    return df.withColumn(rank_col, fn().over(w)).filter(F.col(rank_col) <= n)


def mom_growth(df: DataFrame, value: str, part: Sequence[str] | str = ("region",),
               order: Sequence[str] = ("year", "month"), out: str = "mom_growth_pct",
               calendar: bool = False) -> DataFrame:
    """Growth of ``value`` over the previous row of its ``part`` in percent, 2 dp.

    Default (as the original): the previous *present* row, ordered by ``order`` ascending
    with NULLs first, so an undated bucket precedes the first month. ``calendar=True``:
    only a row of exactly the previous calendar month counts and undated rows are dropped.
    Growth is NULL when the previous value is NULL or not positive.
    """
    part, order = _names(part), list(order)
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    prev = F.lag(value, 1).over(w)
    if calendar:
        year, month = order
        df = df.filter(F.col(year).isNotNull() & F.col(month).isNotNull())
        idx = F.col(year) * 12 + F.col(month)
        prev = F.when(F.lag(idx, 1).over(w) == idx - 1, prev)
    df = df.withColumn("_prev", prev)
    cur = F.col(value)
    growth = F.when(F.col("_prev").isNotNull() & (F.col("_prev") > 0),
                    ratio_pct(cur - F.col("_prev"), F.col("_prev")))
    return df.withColumn(out, growth).drop("_prev")
