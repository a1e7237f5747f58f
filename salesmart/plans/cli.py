"""Command line for the stage jobs.

Locally ``python -m salesmart.plans.cli ...``; on a cluster ship the package and submit this
file: ``zip -r salesmart.zip salesmart && spark-submit --py-files salesmart.zip
salesmart/plans/cli.py all --input ... --output ...`` (with ``spark.checkpoint.dir`` set to a
shared folder).

    python -m salesmart.plans.cli clean --input RAW --cleaned OUT/cleaned --quarantine OUT/quarantine
    python -m salesmart.plans.cli aggregate --cleaned OUT/cleaned --kpis OUT/aggregated [--as-of 2024-06-01]
    python -m salesmart.plans.cli consolidate --kpis OUT/aggregated --output OUT
    python -m salesmart.plans.cli all --input RAW --output OUT
    python -m salesmart.plans.cli ingest --input RAW --output OUT --checkpoint CKPT
    python -m salesmart.plans.cli ingest --input RAW --output OUT --ledger LEDGER     (changed and removed files too)
    python -m salesmart.plans.cli generate --rows 1000000 --output RAW [--dirt 0.02] [--seed 42]
"""

from __future__ import annotations

import argparse
import json

from salesmart.plans.jobs import Run, run_aggregate, run_all, run_clean, run_consolidate
from salesmart.plans.refresh import refresh_aggregates
from salesmart.session import get_spark


def main(argv=None) -> dict:
    p = argparse.ArgumentParser(prog="salesmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--input", required=True)
    c.add_argument("--cleaned", required=True)
    c.add_argument("--quarantine", required=True)
    c.add_argument("--header-check", action="store_true")
    a = sub.add_parser("aggregate")
    a.add_argument("--cleaned", required=True)
    a.add_argument("--kpis", required=True)
    a.add_argument("--as-of")
    a.add_argument("--cache", action="store_true")
    a.add_argument("--incremental", action="store_true", help="only what changed since the last such run")
    s = sub.add_parser("consolidate")
    s.add_argument("--kpis", required=True)
    s.add_argument("--output", required=True)
    al = sub.add_parser("all")
    al.add_argument("--input", required=True)
    al.add_argument("--output", required=True)
    al.add_argument("--as-of")
    i = sub.add_parser("ingest")
    i.add_argument("--input", required=True)
    i.add_argument("--output", required=True)
    how = i.add_mutually_exclusive_group(required=True)
    how.add_argument("--checkpoint")
    how.add_argument("--ledger")
    g = sub.add_parser("generate")
    g.add_argument("--rows", type=int, default=1_000_000)
    g.add_argument("--output", required=True)
    g.add_argument("--dirt", type=float, default=0.02)
    g.add_argument("--seed", type=int, default=42)
    for sp in (c, a, s, al, i, g):
        sp.add_argument("--job", default="salesmart")
        sp.add_argument("--run-id")
    args = p.parse_args(argv)

    spark = get_spark()
    run = Run(job=args.job, **({"run_id": args.run_id} if args.run_id else {}))
    if args.cmd == "clean":
        out = run_clean(spark, args.input, args.cleaned, args.quarantine, run, header_check=args.header_check)
    elif args.cmd == "aggregate" and args.incremental:
        months = refresh_aggregates(spark, args.cleaned, args.kpis, run, as_of=args.as_of)
        out = {"months": sorted(months, key=str)}
    elif args.cmd == "aggregate":
        out = run_aggregate(spark, args.cleaned, args.kpis, run, as_of=args.as_of, cache=args.cache)
    elif args.cmd == "consolidate":
        out = run_consolidate(spark, args.kpis, args.output, run)
    elif args.cmd == "all":
        out = run_all(spark, args.input, args.output, run, as_of=args.as_of)
    elif args.cmd == "generate":
        from salesmart.operators.synth import generate_csv
        out = {"output": generate_csv(spark, args.rows, args.output, args.dirt, args.seed)}
    elif args.ledger:
        from salesmart.streaming import ingest_files
        out = ingest_files(spark, args.input, f"{args.output}/cleaned", f"{args.output}/quarantine", args.ledger,
                           run_ts=run.run_ts, job=run.job)
    else:
        from salesmart.streaming import ingest_available
        ingest_available(spark, args.input, f"{args.output}/cleaned", f"{args.output}/quarantine",
                         args.checkpoint, run_id=run.run_id, run_ts=run.run_ts, job=run.job)
        out = {"cleaned": f"{args.output}/cleaned"}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
