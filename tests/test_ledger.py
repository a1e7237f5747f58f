"""Ingest by the file ledger: after any uploads, changes and removals the table is the batch job's over the files that are there."""

import os

import pytest

from helpers import raw_df, row
from salesmart.operators import clean as C
from salesmart.schema import RAW_COLUMNS
from salesmart.sinks.versions import VersionedTable
from salesmart.sources.csv import read_raw_sales
from salesmart.sources.parquet import read_cleaned
from salesmart.streaming import FileLedger, current_rejections, ingest_files
from salesmart.streaming import ledger as L


class Inbox:
    def __init__(self, spark, base):
        self.spark, self.base, self.tick = spark, base, 1_700_000_000
        self.inbox, self.out, self.quar, self.ledger = (f"{base}/{n}" for n in ("in", "cleaned", "q", "ledger"))
        os.makedirs(self.inbox)

    def put(self, name, *rows):
        path = f"{self.inbox}/{name}.csv"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("\n".join([",".join(RAW_COLUMNS), *(r if isinstance(r, str) else ",".join(r) for r in rows)]) + "\n")
        self.tick += 10
        os.utime(path, (self.tick, self.tick))

    def remove(self, name):
        os.unlink(f"{self.inbox}/{name}.csv")

    def ingest(self, **kw):
        return ingest_files(self.spark, self.inbox, self.out, self.quar, self.ledger, **kw)

    def table(self):
        return sorted((r.order_id, str(r.order_date)[:10], r.quantity, str(r.dt)) for r in read_cleaned(self.spark, self.out).collect())

    def batch(self):
        rows = C.clean(read_raw_sales(self.spark, self.inbox)).collect()
        return sorted((r.order_id, str(r.order_date)[:10], r.quantity, str(r.asDict().get("dt"))) for r in rows)


def test_files_change_and_go(spark, tmp_dir):
    box = Inbox(spark, tmp_dir)
    box.put("dt=2024-01-01/a", row(), row(order_id="ORD-2"), row(order_id="ORD-3", quantity="-1"))
    box.put("dt=2024-01-02/b [1]", row(order_date="2024-03-01", quantity="7"), row(order_id="ORD-4"))
    assert box.ingest() == {"new": 2} and box.table() == box.batch()
    assert box.ingest() == {} and VersionedTable(spark, box.out).numbers() == [1]
    # the later version of ORD-1 goes, so the one that lost comes back, in another month; a row is corrected, one is new
    box.put("dt=2024-01-02/b [1]", row(order_id="ORD-4", quantity="9"), row(order_id="ORD-5", order_date="2024-05-05"))
    assert box.ingest() == {"changed": 1} and box.table() == box.batch()
    assert ("ORD-1", "2024-01-15", 2, "2024-01-01") in box.table()
    # equal length, other time; its rejected row is valid now
    box.put("dt=2024-01-01/a", row(), row(order_id="ORD-2"), row(order_id="ORD-3", quantity="11"))
    box.put("dt=2024-01-03/c", row(order_id="ORD-2", order_date="2024-02-02"), row(order_id="", quantity="3"), "lone")
    assert box.ingest() == {"changed": 1, "new": 1} and box.table() == box.batch()
    rejections = current_rejections(spark, box.quar, box.ledger).collect()
    assert sorted(r.quarantine_reason for r in rejections) == sorted(
        r.quarantine_reason for r in C.quarantine(read_raw_sales(spark, box.inbox, malformed=True)).collect())
    box.remove("dt=2024-01-03/c")
    with pytest.raises(ValueError, match="1 files"):
        box.ingest(removals=False)
    assert box.ingest() == {"removed": 1} and box.table() == box.batch() and box.ingest() == {}
    box.put("dt=2024-01-03/c", row(order_id="ORD-9"))
    assert box.ingest() == {"changed": 1} and box.table() == box.batch()
    entries = {r.file.split("/")[-1]: r.rows for r in FileLedger(spark, box.ledger).current().collect()}
    assert sorted(entries.values()) == [1, 2, 3]


def test_all_files_go(spark, tmp_dir):
    box = Inbox(spark, tmp_dir)
    assert box.ingest() == {}
    box.put("only", row(quantity="-1"))
    assert box.ingest() == {"new": 1}
    box.put("only", row())
    assert box.ingest() == {"changed": 1} and box.table() == [("ORD-1", "2024-01-15", 2, "None")]
    box.remove("only")
    assert box.ingest() == {"removed": 1} and box.table() == []


@pytest.mark.parametrize("step", ["record", "merge_latest", "finish"])
@pytest.mark.parametrize("after", [False, True])
def test_crash_then_other_files(spark, tmp_dir, monkeypatch, step, after):
    """A run is lost at a step, and the files change again before the next."""
    box = Inbox(spark, tmp_dir)
    box.put("a", row(), row(order_id="ORD-2"))
    box.ingest()
    box.put("a", row(order_date="2024-02-02"), row(order_id="ORD-3"))
    box.put("b", row(order_id="ORD-2", quantity="5"), row(order_id="ORD-6"))
    owner = L if step == "merge_latest" else FileLedger
    whole = getattr(owner, step)

    def failing(*args, **kw):
        if after:
            whole(*args, **kw)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(owner, step, failing)
        with pytest.raises(OSError):
            box.ingest()
    box.put("a", row(order_id="ORD-3", order_date="2024-04-04"))
    box.remove("b")
    box.ingest()
    assert box.table() == box.batch() and box.ingest() == {}


def test_only_files_that_share_a_key_are_read(spark, tmp_dir, monkeypatch):
    box = Inbox(spark, tmp_dir)
    for k in range(4):
        box.put(f"f{k}", row(order_id=f"ORD-{k}"), row(order_id=f"ORD-{k // 2}0"))
    box.ingest()
    seen = []
    monkeypatch.setattr(L, "read_raw_sales", lambda s, paths, **kw: seen.extend(paths) or read_raw_sales(s, paths, **kw))
    box.put("f0", row(order_id="ORD-0"))
    box.ingest()
    assert sorted(p.split("/")[-1] for p in seen) == ["f0.csv", "f1.csv"] and box.table() == box.batch()
