"""Versions of the cleaned table, its key filters, and counts from what was committed."""
import random

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import raw_df, row
from salesmart.operators import membership as M
from salesmart.operators.clean import QUALITY, tag_quality
from salesmart.plans.jobs import Run, run_clean
from salesmart.sinks.files import Files
from salesmart.sinks.versions import PERIOD, VersionedTable
from salesmart.sources.parquet import read_cleaned
from salesmart.streaming import incremental, merge_latest

KEY = ("order_id", "product_id")


def ok_rows(spark, *rows):
    return tag_quality(raw_df(spark, *rows)).filter(f"{QUALITY} = 'ok'").drop(QUALITY)


def ids(df):
    return sorted(r.order_id for r in df.collect())


@pytest.mark.parametrize("keys", [1, 3000, 40_000])
def test_no_false_negative_and_few_false_positives(spark, keys):
    rows = spark.range(keys).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).cast("int").alias("g"))
    counts = {(r.g,): r["count"] for r in rows.groupBy("g").count().collect()}
    filters = M.build_filters(M.with_blocks(rows, ["g"], counts), ["g"], ["k"]).cache()
    sizes = [M.blocks_for(n) for n in counts.values()]
    found = M.probe(filters, rows.select("k"), ["g"], ["k"], sizes)
    assert found.join(rows, ["g", "k"]).count() == keys
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("k"))
    assert M.probe(filters, others, ["g"], ["k"], sizes).count() <= 30


def test_filters_merge(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("g"))
    sized = M.with_blocks(rows, ["g"], {(1,): 5000})
    parts = [M.build_filters(sized.filter(F.col("k") % 2 == p), ["g"], ["k"]) for p in (0, 1)]
    merged = M.merge_filters(parts[0].unionByName(parts[1]), ["g"])
    as_set = lambda df: {(r.block, bytes(r.bitmap)) for r in df.collect()}
    assert as_set(merged) == as_set(M.build_filters(sized, ["g"], ["k"]))


def test_filters_are_built_without_a_sort_of_every_bit(spark):
    rows = M.with_blocks(spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("int").alias("g")), ["g"], {(0,): 2500, (1,): 2500})
    filters = M.build_filters(rows, ["g"], ["k"])
    plan = filters._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "bitmap_construct_agg" not in plan
    bits = rows.select("g", "blocks", M._block(["k"]).alias("block"), F.explode(F.array(*M._bits(M._spot(["k"])))).alias("bit"))
    plain = bits.groupBy("g", "block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap"))
    as_set = lambda df: {(r.g, r.block, bytes(r.bitmap)) for r in df.collect()}
    assert as_set(filters) == as_set(plain)


def test_probe_carries_other_columns(spark):
    rows = spark.range(300).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("int").alias("g"), (F.col("id") * 2).alias("x"))
    filters = M.build_filters(M.with_blocks(rows, ["g"], {(0,): 150, (1,): 150}), ["g"], ["k"])
    found = M.probe(filters, rows.select("k", "x"), ["g"], ["k"], [1], carry=["x"])
    assert {(r.g, r.x) for r in rows.collect()} <= {(r.g, r.x) for r in found.collect()} and found.columns == ["g", "x"]


def test_a_merge_joins_no_table_rows_with_the_batch_keys(spark, tmp_dir, monkeypatch):
    plans, write = [], VersionedTable.write

    def seen(self, content, commit):
        plans.append(content._jdf.queryExecution().optimizedPlan().toString())
        return write(self, content, commit)
    monkeypatch.setattr(VersionedTable, "write", seen)
    for day, ids_of in (("05", ("ORD-1", "ORD-2")), ("06", ("ORD-2", "ORD-3"))):
        merge_latest(spark, ok_rows(spark, *(row(order_id=i, order_date=f"2024-01-{day}") for i in ids_of)), f"{tmp_dir}/cleaned", day)
    assert len(plans) == 2 and "Join" not in plans[1]
    assert sorted((r.order_id, r.order_date.day) for r in read_cleaned(spark, f"{tmp_dir}/cleaned").collect()) == [
        ("ORD-1", 5), ("ORD-2", 6), ("ORD-3", 6)]


def test_versions_stay_readable(spark, tmp_dir):
    out = f"{tmp_dir}/cleaned"
    for k in range(4):
        merge_latest(spark, ok_rows(spark, row(order_id=f"ORD-{k}", order_date=f"2024-0{1 + k % 2}-05")), out, f"b{k}", keep=3)
    table = VersionedTable(spark, out)
    assert table.numbers() == [2, 3, 4] and ids(read_cleaned(spark, out)) == [f"ORD-{k}" for k in range(4)]
    assert [ids(read_cleaned(spark, out, version=n)) for n in (2, 3)] == [["ORD-0", "ORD-1"], ["ORD-0", "ORD-1", "ORD-2"]]
    assert [table.version(n).rows for n in (2, 3, 4)] == [2, 3, 4]
    table.expire(1)
    assert table.numbers() == [4] and ids(read_cleaned(spark, out)) == [f"ORD-{k}" for k in range(4)]
    assert len([n for n in Files(spark).names(out) if n.startswith("commit=")]) == 2
    assert len(Files(spark).names(f"{out}/_index")) == 2


def test_a_reader_keeps_its_version(spark, tmp_dir):
    out = f"{tmp_dir}/cleaned"
    merge_latest(spark, ok_rows(spark, row()), out, "b0")
    reader = read_cleaned(spark, out)
    merge_latest(spark, ok_rows(spark, row(order_date="2024-05-01"), row(order_id="ORD-9")), out, "b1")
    assert ids(reader) == ["ORD-1"] and ids(read_cleaned(spark, out)) == ["ORD-1", "ORD-9"]


def test_only_hit_months_are_opened(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/cleaned"
    merge_latest(spark, ok_rows(spark, *(row(order_id=f"ORD-{m}", order_date=f"2024-{m:02d}-05") for m in range(1, 13))), out, "b0")
    opened = []
    read = VersionedTable.read

    def watched(self, version=None, months=None):
        df = read(self, version, months)
        if months is not None:
            files = df.inputFiles()
            assert all(any(f"/month={m}/" in f for _, m in months) for f in files)
            opened.append(set(months))
        return df
    monkeypatch.setattr(VersionedTable, "read", watched)
    before = VersionedTable(spark, out).version()
    merge_latest(spark, ok_rows(spark, row(order_id="ORD-3", order_date="2024-07-09")), out, "b1")
    assert opened == [{(2024, 3)}, {(2024, 3), (2024, 7)}]      # the keys of March, then both months
    after = VersionedTable(spark, out).version()
    same = {m for m in before.months if m in after.months and before.months[m] == after.months[m]}
    assert same == {(2024, m) for m in range(1, 13)} - {(2024, 3), (2024, 7)} and (2024, 3) not in after.months
    monkeypatch.undo()
    assert ids(read_cleaned(spark, out, periods=[(2024, 7)])) == ["ORD-3", "ORD-7"]


def test_random_batches_equal_one_table(spark, tmp_dir):
    """Merged batch by batch, with and without the batch job's table below, the rows are those of a dict of latest versions."""
    rng, out, latest = random.Random(4), f"{tmp_dir}/cleaned", {}
    for k in range(5):
        batch = {}
        for _ in range(30):
            i, day = f"ORD-{rng.randrange(40)}", f"2024-{rng.randrange(1, 5):02d}-{rng.randrange(1, 28):02d}"
            day = "not-a-date" if rng.random() < 0.1 else day
            if day > batch.get(i, "") or batch.get(i) == "not-a-date":
                batch[i] = day
        batch["ORD-u"] = "not-a-date"
        rows = [row(order_id=i, order_date=d) for i, d in batch.items()]
        if k == 0:
            raw_df(spark, *rows).write.option("header", "true").csv(f"{tmp_dir}/in")
            run_clean(spark, f"{tmp_dir}/in", out, f"{tmp_dir}/q", Run())
        else:
            merge_latest(spark, ok_rows(spark, *rows), out, f"b{k}")
        for i, d in batch.items():
            before = latest.get(i, "not-a-date")
            if before == "not-a-date" or d != "not-a-date" and d > before:
                latest[i] = d
    got = {r.order_id: "not-a-date" if r.order_date is None else f"{r.order_date:%Y-%m-%d}" for r in read_cleaned(spark, out).collect()}
    assert got == latest and VersionedTable(spark, out).version().months.keys() >= {(None, None)}


def test_counts_are_those_of_committed_files(spark, tmp_dir):
    """A task that is run again writes its rows twice, and they are counted once."""
    flag = f"{tmp_dir}/failed"
    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])

    def flaky(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 0:
            open(flag, "w").close()
            raise RuntimeError("lost")
    rows = spark.range(0, 1000, 1, 2).select(F.col("id").cast("string").alias("order_id"), F.lit(2024).alias("year"), (F.col("id") % 2).cast("int").alias("month"))
    table = VersionedTable(spark, f"{tmp_dir}/t")
    if spark.sparkContext.master.startswith("local[") and "," not in spark.sparkContext.master:
        # local mode doesn't run a task again, so the try as a whole is: its first files are replaced
        with pytest.raises(Exception, match="lost"):
            table.write(rows.mapInPandas(flaky, schema), "c1")
        new = table.write(rows, "c1")
    else:
        new = table.write(rows.mapInPandas(flaky, schema), "c1")
    assert {m: p.rows for m, p in new.items()} == {(2024, 0): 500, (2024, 1): 500}
    assert table.publish(None, "c1", schema, new, new).rows == 1000 == table.read().count()


def test_two_writers(spark, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t")
    rows = spark.createDataFrame([("a", 2024, 1)], "order_id string, year int, month int")
    new = table.write(rows, "c1")
    table.publish(None, "c1", rows.schema, new, new)
    with pytest.raises(RuntimeError, match="another writer"):
        table.publish(None, "c2", rows.schema, new, new)


def test_emptied_table(spark, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t")
    rows = spark.createDataFrame([("a", 2024, 1)], "order_id string, year int, month int")
    first = table.publish(None, "c1", rows.schema, new := table.write(rows, "c1"), new)
    assert table.write(rows.filter("false"), "c2") == {}
    table.publish(first, "c2", rows.schema, [(2024, 1)], {})
    assert table.read().columns == ["order_id", *PERIOD] and table.read().count() == 0 and table.read(1).count() == 1
    assert incremental.months_of_keys(table, table.version(), rows.select("order_id"), ["order_id"]) == set()
