import base64
import hashlib

import duckdb
from pyspark.sql import functions as F

from salesmart.llm import warc
from salesmart.llm.common import shared_folder, table
from salesmart.llm.oracle import WARC

SCHEMA = "page_id long, url string, html string, digest string, type string, `a.b` int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", None, 1) for r in rows], SCHEMA)


ODD = [(1, "http://a.de/x?q=1#top", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://a.de", None), (4, "", ""), (5, "no url\r\nX: y", "a\r\n\r\nb\n\nWARC/1.1\r\n"),
       (6, "http://b.fr/é", "é\U0001F600" * 10), (7, "http://l.de/", "line\n" * 60_000 + "z" * 200_000), (8, "http://c", "\n"), (9, "http://c", "x\r"),
       (10, "http://c", "\r\n\r\n"), (None, "http://n", "<p>one</p>"), (None, "http://n", "alone")]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_odd_pages(spark):
    got = warc.round_trip(pages(spark, ODD)).collect()
    same = {}
    for i, _, h in ODD:
        same.setdefault(h or "", []).append(i)
    want = []
    for i, _, h in ODD:
        first = max((x for x in same[h or ""] if x is not None), default=None)
        want.append((i, len((h or "").encode()), digest(h), "response" if i == first else "revisit", None if i == first else first))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def outcome(rows):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in rows)


def test_least_bytes_and_repeated_rows(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb"), (4, "u", "bbbb"), (4, "v", "bbbb"), (4, "u", "other")]
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.round_trip(pages(spark, rows), least_bytes=3).collect())
    assert got == [(1, 2, "response", 0), (2, 2, "response", 0), (2, 2, "response", 0), (3, 4, "revisit", 4),
                   (4, 4, "response", 0), (4, 4, "revisit", 4), (4, 4, "revisit", 4), (4, 5, "response", 0)]


def test_small_repeats_keep_their_payload(spark):
    path = shared_folder(spark, "test-warc")
    warc.write_archives(pages(spark, [(7, "u", "aa")] * 3 + [(8, None, "long one")] * 2), path, least_bytes=3)
    got = sorted((r.type, r.payload) for r in warc.read_archives(spark, path).filter("type IN ('response', 'revisit')").collect()
                 if r.payload is not None)
    assert got == [("response", b"aa")] * 3 + [("response", b"long one")]


def test_against_sql_with_repeats(spark, tmp_dir):
    """The query's own SQL on a table of repeated rows: whole rows, page_ids with several urls, and null keys."""
    rows = [(k % 40 if k % 11 else None, f"http://h/{k % 3}", (None, "", "p" * (k % 4), f"page {k % 9}")[k % 4]) for k in range(400)]
    df = pages(spark, rows).coalesce(1)
    df.select("page_id", "url", "html").write.parquet(f"{tmp_dir}/pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_dir}/pages/*.parquet'")
    want = sorted((str(p), b, d, t, str(f)) for p, b, d, t, f in con.execute(
        f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({WARC})").fetchall())
    assert outcome(warc.round_trip(df).collect()) == want


def test_row_repeated_very_often(spark):
    """Repeats are numbered in blocks that are dealt over the tasks."""
    df = spark.range(5000).select(F.lit(9).cast("long").alias("page_id"), F.lit("http://a/").alias("url"), F.lit("<p>one</p>").alias("html"))
    got = warc.round_trip(df).groupBy("record_type", "refers_to").count().collect()
    assert sorted((r.record_type, r.refers_to, r["count"]) for r in got) == [("response", None, 1), ("revisit", 9, 4999)]


def test_nested_rows(spark):
    path = shared_folder(spark, "test-warc")
    warc.write_archives(pages(spark, ODD[:3]), path)
    records = warc.read_archives(spark, path).cache()
    assert {r.type: r["count"] for r in records.groupBy("type").count().collect()} == {"request": 3, "response": 2, "revisit": 1, "metadata": 3}
    rows = {r.metadata.fields.split()[1]: r for r in warc.assemble(records).collect()}
    assert rows["2"].payload == b"<p>one</p>" and rows["2"].uri is None and rows["1"].payload is None
    assert rows["1"].refers_to == rows["2"].record_id and rows["1"].digest == digest("<p>one</p>")
    assert rows["1"].request.fields == "GET /x?q=1 HTTP/1.1\r\nHost: a.de\r\n\r\n" and rows["3"].payload == b""


def test_lone_records(spark):
    path = shared_folder(spark, "test-warc")
    warc.write_archives(pages(spark, ODD[:1]), path)
    records = warc.read_archives(spark, path)
    assert warc.assemble(records.filter("type <> 'response'")).count() == 0
    alone = warc.assemble(records.filter("type = 'response'")).first()
    assert alone.request is None and alone.metadata is None


def test_archives_of_others(spark):
    path = shared_folder(spark, "test-other")
    other = ("WARC/1.0\nWARC-Type: warcinfo\nContent-Length: 3\n\nabc\n\n"
             "WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <r:1>\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhe\nlo\r\n\r\n")
    spark.createDataFrame([(other,)], "value string").coalesce(1).write.text(path)
    rows = {r.type: r for r in warc.read_archives(spark, path).collect()}
    assert rows["warcinfo"].fields == "abc" and rows["response"].payload == b"he\nlo"


def test_base32(spark):
    rows = [(hashlib.sha1(bytes([k])).hexdigest(),) for k in range(50)]
    got = spark.createDataFrame(rows, "h string").select("h", warc.base32_of_hex(F.col("h")).alias("b")).collect()
    assert all(r.b == base64.b32encode(bytes.fromhex(r.h)).decode() for r in got)


def test_empty(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_real_pages(spark):
    rows = table(spark, "/root/testdata/sf0.001", "pages")
    assert warc.round_trip(rows).count() == rows.count()


def test_hot_payload_is_split(spark):
    """A payload on a third of all pages is joined by several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sha = F.sha1(F.when(F.col("id") % 3 == 0, 0).otherwise(F.floor(F.col("id") / 2)).cast("string"))
        narrow = spark.range(0, 60_000, 1, 8).select(F.xxhash64("id").alias("page_id"), F.lit("u").alias("url"), sha.alias("sha"))
        found = warc._revisits(narrow)
        assert found.filter(F.col("again_sha") == F.sha1(F.lit("0"))).count() > 19_000
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
