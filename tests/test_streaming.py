"""Incremental ingest over file drops equals the batch clean over all files."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_check import py_rows
from salesmart.operators import clean as C
from salesmart.plans import queries as Q
from salesmart.plans.io_queries import DROPS, FIXTURE_RAW_SCHEMA, drop_of, write_raw_csv
from salesmart.sources.fixtures import FIXTURE_TIES
from salesmart.sources.parquet import read_cleaned
from salesmart.streaming import ingest_available


def test_stream_equals_batch_with_late_versions(spark, tmp_dir):
    raw = Q.raw(spark, SF_SMALL).withColumn("dt", drop_of())
    # third drop: 50 keys again, dated later and in another month (moves rows between partitions)
    late = (Q.raw(spark, SF_SMALL).filter(F.col("order_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
                                          & F.col("order_id").startswith("ORD-"))
            .orderBy("order_id", "product_id").limit(50)
            .withColumn("order_date", F.lit("2001-12-24")))
    inbox, out, quar, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/cleaned", f"{tmp_dir}/q", f"{tmp_dir}/ckpt"
    drops = [raw.filter(F.col("dt") == d).drop("dt") for d in DROPS] + [late]
    for i, d in enumerate(drops):
        write_raw_csv(d.coalesce(1), f"{inbox}/dt=2001-08-0{i + 1}", partition_by_dt=False)
        ingest_available(spark, inbox, out, quar, ckpt, schema=FIXTURE_RAW_SCHEMA, ties=FIXTURE_TIES,
                         max_files_per_trigger=1)
    # rerun over the same files: nothing new
    ingest_available(spark, inbox, out, quar, ckpt, schema=FIXTURE_RAW_SCHEMA, ties=FIXTURE_TIES)

    everything = raw.drop("dt").unionByName(late)
    batch = C.clean(everything, ties=FIXTURE_TIES)
    stream = read_cleaned(spark, out)
    moved = stream.filter("year = 2001 and month = 12").count()
    assert moved > 40 and moved == batch.filter("year = 2001 and month = 12").count()
    cols = batch.columns
    assert py_rows(cols, [tuple(r) for r in stream.select(*cols).collect()]) == \
        py_rows(cols, [tuple(r) for r in batch.collect()])
    assert spark.read.parquet(quar).count() == C.quarantine(everything).count()
