"""The registered table follows its files; what changed is logged."""
import datetime as dt
import os

import pytest

from salesmart.sources import catalog as C

DAY = dt.datetime(2024, 6, 1)


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture()
def table(spark, tmp_dir):
    name = f"raw_{os.path.basename(tmp_dir).replace('-', '_')}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def update(spark, tmp_dir, table, k, **kw):
    return [tuple(r[c] for c in ("column", "change", "old_type", "new_type", "position")) for r in
            C.update_table(spark, f"{tmp_dir}/in", table, f"{tmp_dir}/log", f"run-{k}", DAY + dt.timedelta(days=k), **kw).collect()]


def test_wider():
    assert [C.wider(*x) for x in (("int", "bigint"), ("double", "int"), ("date", "timestamp"), ("date", "int"), ("boolean", "string"), ("int", "int"))] == \
        ["bigint", "double", "timestamp", "string", "string", "int"]


def test_changed_header(spark, tmp_dir, table):
    put(f"{tmp_dir}/in", "a.csv", "id,qty,day", "x,1,2024-01-01", "y,2,")
    assert update(spark, tmp_dir, table, 0) == [("id", "created", None, "string", 0), ("qty", "created", None, "int", 1), ("day", "created", None, "date", 2)]
    assert update(spark, tmp_dir, table, 1) == []
    put(f"{tmp_dir}/in", "b.csv", 'note,"id",qty', '"a, b",z,2.5')
    assert sorted(update(spark, tmp_dir, table, 2)) == [("note", "added", None, "string", 3), ("qty", "widened", "int", "double", 1)]
    assert spark.table(table).dtypes == [("id", "string"), ("qty", "double"), ("day", "date"), ("note", "string")]
    rows = sorted(map(tuple, C.read_registered(spark, f"{tmp_dir}/in", table, f"{tmp_dir}/log").collect()), key=str)
    assert rows == [("x", 1.0, dt.date(2024, 1, 1), None), ("y", 2.0, None, None), ("z", 2.5, None, "a, b")]


def test_vanished_column_stays_and_returns(spark, tmp_dir, table):
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,1")
    update(spark, tmp_dir, table, 0)
    put(f"{tmp_dir}/in", "a.csv", "id", "x")
    assert update(spark, tmp_dir, table, 1) == [("qty", "removed", "int", "int", 1)]
    assert update(spark, tmp_dir, table, 2) == [] and spark.table(table).columns == ["id", "qty"]
    assert [tuple(r) for r in C.read_registered(spark, f"{tmp_dir}/in", table, f"{tmp_dir}/log").collect()] == [("x", None)]
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,7")
    assert update(spark, tmp_dir, table, 3) == [("qty", "returned", "int", "int", 1)]


def test_column_without_values_does_not_widen(spark, tmp_dir, table):
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,1")
    update(spark, tmp_dir, table, 0)
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,")
    assert update(spark, tmp_dir, table, 1) == []
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,many")
    assert update(spark, tmp_dir, table, 2) == [("qty", "widened", "int", "string", 1)]


def test_repeated_run_after_a_crash(spark, tmp_dir, table, monkeypatch):
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,1")
    update(spark, tmp_dir, table, 0)
    put(f"{tmp_dir}/in", "b.csv", "id,qty,more", "y,2,3")
    want = [("more", "added", None, "int", 2)]
    with monkeypatch.context() as m:
        m.setattr(type(spark.catalog), "createTable", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            update(spark, tmp_dir, table, 1)      # the log is written, the old table is dropped
    assert not spark.catalog.tableExists(table)
    assert update(spark, tmp_dir, table, 1) == want and spark.table(table).columns == ["id", "qty", "more"]
    log = C.change_log(spark, f"{tmp_dir}/log")
    assert log.count() == 3 and {r.run_ts for r in log.collect()} == {DAY, DAY + dt.timedelta(days=1)}


def test_registered_before_the_log(spark, tmp_dir, table):
    from salesmart.sources.csv import register_raw
    put(f"{tmp_dir}/in", "a.csv", "id,qty", "x,1")
    register_raw(spark, f"{tmp_dir}/in", table)
    put(f"{tmp_dir}/in", "b.csv", "id,qty,more", "y,2.5,3")
    assert sorted(update(spark, tmp_dir, table, 0)) == [("more", "added", None, "int", 2), ("qty", "widened", "int", "double", 1)]


def test_no_files(spark, tmp_dir, table):
    os.makedirs(f"{tmp_dir}/in")
    assert update(spark, tmp_dir, table, 0) == []
