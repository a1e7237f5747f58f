"""Ingest after crashes, over files without valid rows, and into a table the batch job wrote."""

import datetime as dt
import glob
import os

import pytest

from helpers import raw_df, row
from salesmart.operators.clean import QUALITY, tag_quality
from salesmart.plans.io_queries import write_raw_csv
from salesmart.plans.jobs import Run, run_clean
from salesmart.sinks.files import Files
from salesmart.sinks.versions import VersionedTable
from salesmart.sources.parquet import read_cleaned
from salesmart.streaming import incremental, ingest_available, merge_latest


def ok_rows(spark, *rows):
    return tag_quality(raw_df(spark, *rows)).filter(f"{QUALITY} = 'ok'").drop(QUALITY)


def orders(spark, out):
    return sorted((r["order_id"], r["month"]) for r in read_cleaned(spark, out).collect())


def test_file_of_rejected_rows_only(spark, tmp_dir):
    inbox, out, quar, ckpt = (f"{tmp_dir}/{n}" for n in ("in", "cleaned", "q", "ckpt"))
    write_raw_csv(raw_df(spark, row(quantity="-1")), f"{inbox}/dt=2024-01-01", partition_by_dt=False)
    ingest_available(spark, inbox, out, quar, ckpt)
    write_raw_csv(raw_df(spark, row()), f"{inbox}/dt=2024-01-02", partition_by_dt=False)
    ingest_available(spark, inbox, out, quar, ckpt)
    write_raw_csv(raw_df(spark, row(order_id="")), f"{inbox}/dt=2024-01-03", partition_by_dt=False)
    ingest_available(spark, inbox, out, quar, ckpt)
    assert orders(spark, out) == [("ORD-1", 1)] and spark.read.parquet(quar).count() == 2


def test_malformed_lines_of_a_drop(spark, tmp_dir):
    inbox, out, quar, ckpt = (f"{tmp_dir}/{n}" for n in ("in", "cleaned", "q", "ckpt"))
    write_raw_csv(raw_df(spark, row(), row(order_id="ORD-2")).coalesce(1), f"{inbox}/dt=2024-01-01", partition_by_dt=False)
    path = next(p for p in Files(spark).walk(f"{inbox}/dt=2024-01-01") if p.endswith(".csv"))
    with open(path.removeprefix("file:"), "a") as f:
        f.write("lone\n")
    for crc in glob.glob(f"{inbox}/dt=2024-01-01/.*.crc"):
        os.unlink(crc)
    ingest_available(spark, inbox, out, quar, ckpt, malformed=True)
    bad = spark.read.parquet(quar).collect()
    assert [(r.quarantine_reason, r.malformed_record, r.source_file.endswith(".csv")) for r in bad] == [("malformed_record", "lone", True)]
    assert orders(spark, out) == [("ORD-1", 1), ("ORD-2", 1)] and "source_file" not in read_cleaned(spark, out).columns


def test_ingest_into_the_batch_jobs_table(spark, tmp_dir):
    inbox, out, quar, ckpt = (f"{tmp_dir}/{n}" for n in ("in", "cleaned", "q", "ckpt"))
    write_raw_csv(raw_df(spark, row(), row(order_id="ORD-2")), f"{inbox}/dt=2024-01-01", partition_by_dt=False)
    first = Run(run_ts=dt.datetime(2024, 2, 1))
    run_clean(spark, inbox, out, quar, first)
    before = read_cleaned(spark, out)
    other = f"{tmp_dir}/in2"
    write_raw_csv(raw_df(spark, row(order_date="2024-01-20")), f"{other}/dt=2024-01-02", partition_by_dt=False)
    ingest_available(spark, other, out, quar, ckpt, run_ts=dt.datetime(2024, 3, 1))
    after = read_cleaned(spark, out)
    assert sorted(after.columns) == sorted(before.columns)
    got = {r.order_id: (r.dt, r.etl_processed_at, r.etl_job) for r in after.collect()}
    assert got == {"ORD-1": (dt.date(2024, 1, 2), dt.datetime(2024, 3, 1), "salesmart"),
                   "ORD-2": (dt.date(2024, 1, 1), dt.datetime(2024, 2, 1), "salesmart")}


STEPS = [(VersionedTable, "write"), (incremental, "index_months"), (Files, "write_text"), (Files, "move"), (VersionedTable, "expire")]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("owner, step", STEPS)
def test_crash_at_each_step(spark, tmp_dir, monkeypatch, owner, step, after):
    """A reader at the moment of the crash sees the old or the new table, whole; the replayed batch ends in the new one."""
    out = f"{tmp_dir}/cleaned"
    merge_latest(spark, ok_rows(spark, row(), row(order_id="ORD-2"), row(order_id="ORD-3", order_date="2024-02-02")), out, "b0")
    old, new = [("ORD-1", 1), ("ORD-2", 1), ("ORD-3", 2)], [("ORD-1", 3), ("ORD-2", 1), ("ORD-3", 2)]
    batch = ok_rows(spark, row(order_date="2024-03-15"), row(order_id="ORD-3", order_date="2024-01-09", quantity="3"),
                    row(order_id="ORD-3", order_date="2024-02-03"))
    whole = getattr(owner, step)

    def failing(*args, **kw):
        if after:
            whole(*args, **kw)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(owner, step, failing)
        with pytest.raises(OSError):
            merge_latest(spark, batch, out, "b1")
    published = (step, after) in (("move", True), ("expire", False), ("expire", True))
    assert orders(spark, out) == (new if published else old)
    for _ in range(2):      # the batch again, and once more after its commit was lost
        merge_latest(spark, batch, out, "b1")
        assert orders(spark, out) == new
    folders = [n for n in Files(spark).names(out) if n.startswith("commit=")]
    assert VersionedTable(spark, out).numbers() == [1, 2] and len(folders) == 2


def test_scans_are_pruned(spark, tmp_dir, capsys):
    out = f"{tmp_dir}/cleaned"
    merge_latest(spark, ok_rows(spark, row(), row(order_id="ORD-2", order_date="2023-05-05")), out, "b0")
    table = read_cleaned(spark, out)
    keys = spark.createDataFrame([("ORD-1", "PROD-1")], "order_id string, product_id string")
    table.select("order_id", "product_id", "year", "month").join(keys, ["order_id", "product_id"], "left_semi") \
        .select("year", "month").distinct().explain("formatted")
    assert "ReadSchema: struct<order_id:string,product_id:string>" in capsys.readouterr().out
    table.filter(incremental.months_filter({(2024, 1), (None, None)})).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
