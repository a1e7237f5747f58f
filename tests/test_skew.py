"""A key holding a third of all rows: results stay whole and exact under any partitioning."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import raw_df, row
from salesmart.operators import clean as C
from salesmart.operators import kpis as K


def skewed_rows(n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:   # hot natural key, many versions
            rows.append(row(order_id="ORD-HOT", product_id="PROD-HOT", region="HOT",
                            order_date=(dt.date(2024, 1, 1) + dt.timedelta(days=i % 200)).isoformat(),
                            quantity=str(1 + i % 7)))
        else:
            rows.append(row(order_id=f"ORD-{i}", product_id=f"PROD-{i % 50}",
                            region="HOT" if i % 3 == 1 else f"R{i % 4}"))
    return rows


def test_hot_key_dedup_and_aggregates(spark):
    rows = skewed_rows()
    results = []
    for n in (1, 8, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        c = C.clean(raw_df(spark, *rows).repartition(n))
        hot = c.filter("order_id = 'ORD-HOT'").collect()
        a1 = sorted(map(tuple, K.region_country_monthly(c).collect()), key=repr)
        top = sorted(map(tuple, K.top_products_by_region(c).collect()), key=repr)
        results.append((c.count(), [tuple(h) for h in hot], a1, top))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
    count, hot, _, top = results[0]
    assert count == 2000 + 1
    assert len(hot) == 1 and hot[0][8] == dt.datetime(2024, 7, 18)   # latest of the 1000 versions
    assert max(t[-1] for t in top) <= 10
