"""K3 file cap and S5 cache release."""

import glob
import os

from conftest import SF_SMALL
from salesmart.operators import kpis as K
from salesmart.plans import queries as Q
from salesmart.schema import KPI_MAX_FILES
from salesmart.sinks import write_kpi
from salesmart.sources.parquet import cached, read_kpi


def test_kpi_file_cap_per_partition(spark, tmp_dir):
    c = Q.cleaned(spark, SF_SMALL)
    for name in ("region_country_monthly", "monthly_trend"):
        spec = K.KPI_DATASETS[name]
        path = write_kpi(spec.fn(c), tmp_dir, name, spec.partitions, spec.bounded)
        dirs = {os.path.dirname(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}
        assert dirs
        for d in dirs:
            assert len(glob.glob(f"{d}/*.parquet")) <= KPI_MAX_FILES
        assert read_kpi(spark, tmp_dir, name).count() == spec.fn(c).count()


def test_cached_is_released(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k")
    with cached(df) as d:
        assert d.is_cached and d.groupBy("k").count().count() == 7
    assert not df.is_cached
