"""Plan review: ``python -m salesmart.plans.explain [--summary] [--sf DIR] [key ...]``.

Prints ``explain("formatted")`` of registered queries, or with ``--summary`` one line per
query: shuffles, join strategies, partial window limits and any Python evaluation.
"""

from __future__ import annotations

import argparse
import re

from salesmart.plans.queries import QUERIES
from salesmart.session import get_spark

MARKERS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "partial_wgl": r"WindowGroupLimit .*Partial",
    "python": r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def summary(df) -> dict:
    p = df._jdf.queryExecution().executedPlan().toString()
    return {k: len(re.findall(v, p)) for k, v in MARKERS.items()}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--summary", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    spark = get_spark()
    for k in a.keys or [k for k in QUERIES if k not in ("stream_ingest",)]:
        df = QUERIES[k](spark, a.sf)
        if a.summary:
            print(k, summary(df), flush=True)
        else:
            print(f"== {k} ==", flush=True)
            df.explain("formatted")


if __name__ == "__main__":
    main()
