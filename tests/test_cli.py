"""The command line runs the whole chain on raw CSV files."""

import json

from conftest import SF_SMALL
from salesmart.plans import queries as Q
from salesmart.plans.cli import main
from salesmart.plans.io_queries import write_raw_csv


def test_cli_all(spark, tmp_dir):
    write_raw_csv(Q.raw(spark, SF_SMALL), f"{tmp_dir}/input/sales")
    out = main(["all", "--input", f"{tmp_dir}/input", "--output", f"{tmp_dir}/mart", "--run-id", "cli-1",
                "--as-of", "2001-08-01"])
    assert out["metrics"]["raw_rows"] == 6000
    doc = json.loads("".join(r[0] for r in spark.read.text(out["report"]).collect()))
    assert doc["metadata"]["run_id"] == "cli-1" and doc["metadata"]["record_counts"]["regional_rows"] == 25
    assert out["verified"]
