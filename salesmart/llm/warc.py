"""WARC archives: writing them, reading them back, transaction assembly (operator 5).

A page becomes three records: its request and metadata name the capture through
``WARC-Concurrent-To``; the capture is a response, or a revisit that names through
``WARC-Refers-To`` the response that carries the same payload. Each record ends with CRLF CRLF,
which is the text writer's line end here, so Spark's own writer commits the (gzipped) archives
and its own line reader streams them back; a task holds one record at a time. ``assemble``
joins the records of a transaction into one nested row.

Defined results: a null html is an empty payload; a null url leaves the target header out; line
breaks in a url are percent-encoded; page_id may be null and is below any other, as a null url is; repeated rows are
captures of their own, numbered by an aggregate (rows equal in page_id, url and html can't be told apart, so any of them
carries the payload); of equal payloads one record of the largest page_id is the response, the one of the last url and the
first number if there are several; a request or metadata record whose capture isn't in the archives gives no row, a capture without them gives a row with nulls there.
Payloads are written and digested whole. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import shared, shared_folder, whole

END = "\r\n"
RECORD_END = END + END
#: Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD = ("type string, record_id string, concurrent_to string, refers_to string, uri string, date string, "
          "digest string, payload_bytes long, fields string, payload binary")


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hexadecimal string whose length is a multiple of five digits."""
    def four(k: Column) -> Column:     # 20 bits
        v = F.conv(F.substring(digest, k * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*(F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)))
    return F.concat_ws("", F.transform(F.sequence(F.lit(0), (F.length(digest) / 5).cast("int") - 1), four))


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """Headers whose value is null are left out."""
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in headers]
    return F.concat(F.concat_ws(END, F.lit("WARC/1.1"), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block))),
                    F.lit(RECORD_END), block)


#: A row's identity: rows that agree in it are repeats.
SAME = ("page_id", "url", "sha")
AT_ONCE = 1000      # repeats that one row of the numbering stands for while they are dealt over the tasks


def _captures(rows: DataFrame) -> DataFrame:
    """``page_id, url, sha, bytes, n``: each distinct row without its payload, and how often it occurs."""
    return rows.groupBy(*SAME).agg(F.max("bytes").alias("bytes"), F.count("*").alias("n"))


def _revisits(captures: DataFrame) -> DataFrame:
    """``again_id, again_url, again_sha, first, first_url`` of the captures whose payload another one, ``first``, carries. The
    rebalances keep the join from reusing the aggregate's dealing and later ones from reusing the join's, so AQE can split a
    payload that very many pages share."""
    best = captures.groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("best"), F.count("*").alias("n")).filter("n > 1")
    best = best.select("sha", F.col("best.page_id").alias("first"), F.col("best.url").alias("first_url"))
    own = F.col("page_id").eqNullSafe(F.col("first")) & F.col("url").eqNullSafe(F.col("first_url"))
    return captures.select(*SAME).join(best.hint("rebalance"), "sha").filter(~own).select(
        F.col("page_id").alias("again_id"), F.col("url").alias("again_url"), F.col("sha").alias("again_sha"), "first", "first_url").hint("rebalance")


def _same(x: DataFrame, y: DataFrame, names: tuple[str, str, str]) -> Column:
    page, url, sha = names
    return x["page_id"].eqNullSafe(y[page]) & x["url"].eqNullSafe(y[url]) & (x["sha"] == y[sha])


def _numbered(rows: DataFrame, captures: DataFrame, least_bytes: int) -> DataFrame:
    """``rows`` with a ``number`` among their repeats. A repeat beyond the first is made from its identity: it needs no
    payload, unless payloads so small are never revisited."""
    twice = shared(captures.filter("n > 1"), "twice")      # its true size lets Spark send a small one to the tasks
    keys = twice.select(*(F.col(c).alias(f"twice_{c}") for c in SAME))
    on = _same(rows, keys, tuple(f"twice_{c}" for c in SAME))
    single = rows.join(keys, on, "left_anti").select(*SAME, "bytes", "html").withColumn("number", F.lit(1).cast("long"))
    once = rows.join(keys, on, "left_semi").groupBy(*SAME).agg(F.max("bytes").alias("bytes"), F.max("html").alias("html"))
    once = shared(once, "repeated")
    blocks = twice.select(*SAME, "bytes", "n", F.explode(F.sequence(F.lit(2).cast("long"), F.col("n"), F.lit(AT_ONCE).cast("long"))).alias("at"))
    more = blocks.hint("rebalance").select(*SAME, "bytes", F.explode(F.sequence(
        F.col("at"), F.least(F.col("at") + (AT_ONCE - 1), F.col("n")))).alias("number"))
    small = once.filter(F.col("bytes") < least_bytes).select(*(F.col(c).alias(f"of_{c}") for c in SAME), "html")
    more = more.join(small, _same(more, small, tuple(f"of_{c}" for c in SAME)), "left")
    names = [*SAME, "bytes", "html", "number"]
    return single.select(names).unionByName(once.withColumn("number", F.lit(1).cast("long")).select(names)).unionByName(more.select(names))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, date: str = DATE) -> None:
    """Write the records of ``pages``. Of equal payloads of ``least_bytes`` or more the one of the largest key is
    the response."""
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        whole(F.col(f"`{html}`")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html").cast("long"))
    captures = shared(_captures(rows), "captures")
    large = captures.filter(F.col("bytes") >= least_bytes)
    again, numbered = _revisits(large), _numbered(rows, captures, least_bytes)
    rows = numbered.join(again, _same(numbered, again, ("again_id", "again_url", "again_sha")), "left")
    # a repeat of the response revisits it
    repeat = (F.col("number") > 1) & (F.col("bytes") >= least_bytes)
    known = F.col("again_sha").isNotNull()
    first, first_url = F.when(known, F.col("first")).otherwise(F.col("page_id")), F.when(known, F.col("first_url")).otherwise(F.col("url"))

    def name(kind: str, page: Column, of: Column, number: Column) -> Column:
        shown = [F.coalesce(x.cast("string"), F.lit("null")) for x in (page, F.concat(F.lit("="), of))]
        return _urn(F.lit(kind), shown[0], F.col("sha"), number.cast("string"), shown[1])
    own = F.col("page_id"), F.col("url"), F.col("number")
    mine, revisit = name("capture", *own), known | repeat
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    both = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri)]
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("bytes"), F.lit(RECORD_END))
    capture = _record(
        [("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", mine), *both,
         ("WARC-Profile", F.when(revisit, PROFILE)),
         ("WARC-Refers-To", F.when(revisit, name("capture", first, first_url, F.lit(1)))),
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha")))),
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.when(revisit, http).otherwise(F.concat(http, "html")))
    host = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\r\\n]*)", 1)
    target = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\r\\n]*([^#\\r\\n]*)", 1)
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", name("request", *own)), *both,
         ("WARC-Concurrent-To", mine), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(F.coalesce(target, F.lit("")) == "", "/").otherwise(target),
                 F.lit(f" HTTP/1.1{END}Host: "), F.coalesce(host, F.lit("")), F.lit(RECORD_END)))
    about = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", name("metadata", *own)), *both,
         ("WARC-Concurrent-To", mine), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END)))
    rows.select(F.concat_ws(RECORD_END, request, capture, about)) \
        .write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


class _Parser:
    """Records from the lines of one archive."""

    def __init__(self):
        self.head: list[bytes] = []
        self.block: list[bytes] | None = None
        self.need = self.have = 0

    def feed(self, line: bytes) -> tuple[dict[str, str], bytes] | None:
        if self.block is None:
            line = line.rstrip(b"\r")
            if line:
                if self.head or line.startswith(b"WARC/"):
                    self.head.append(line)
                return None
            if not self.head:
                return None
            pairs = (x.decode("utf-8", "replace").partition(":") for x in self.head[1:])
            self.fields = {k.strip().lower(): v.strip() for k, _, v in pairs}
            self.head = []
            self.need, self.have, self.block = int(self.fields.get("content-length") or 0), 0, []
            if self.need:
                return None
        else:
            self.block += [line, b"\n"]
            self.have += len(line) + 1
            if self.have < self.need:
                return None
        block, self.block = b"".join(self.block)[:self.need], None
        return self.fields, block


def _row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, payload = fields.get("warc-type"), None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        digest = fields.get("warc-payload-digest", "").partition(":")[2] or None
    return (kind, fields.get("warc-record-id"), fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
            fields.get("warc-target-uri"), fields.get("warc-date"), digest, None if payload is None else len(payload),
            None if kind in ("response", "revisit") else block.decode("utf-8", "replace"), payload if with_payload else None)


def read_archives(spark, path: str, with_payload: bool = True) -> DataFrame:
    """``RECORD`` rows of the archives under ``path`` (gzipped ones aren't split). A response's digest and length
    are those of the payload as read."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [{"long": pa.int64(), "binary": pa.binary()}.get(x.split()[1], pa.string()) for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, out, held = _Parser(), None, [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        for lines in batches:
            for line, of in zip(lines.column(0).to_pylist(), lines.column(1).to_pylist(), strict=True):
                if of != file:
                    parser, file = _Parser(), of
                if (found := parser.feed(line)) is not None:
                    out.append(_row(*found, with_payload))
                    held += len(found[1])
                    if len(out) >= 1000 or held > 8 << 20:
                        yield batch()
                        out, held = [], 0
        if out:
            yield batch()
    lines = spark.read.option("lineSep", "\n").text(path) \
        .select(F.col("value").cast("binary").alias("line"), F.xxhash64("_metadata.file_path").alias("file"))
    return lines.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its own columns, ``request`` and ``metadata``. ``records`` is read four times
    (give a written table)."""
    def beside(kind: str) -> DataFrame:
        own = records.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return own.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min(F.struct(F.col("record_id").alias("id"), "uri", "date", "fields")).alias(kind))
    captures = records.filter(F.col("type").isin("response", "revisit") & F.col("record_id").isNotNull()) \
        .dropDuplicates(["record_id"]).drop("concurrent_to", "fields")
    return captures.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Contract columns of ``op5``, from archives written and read back."""
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_archives(pages, path, least_bytes=least_bytes)
    records = shared(read_archives(spark, path, with_payload=False), "records")
    number = F.regexp_extract(F.col("metadata.fields"), "page_id: (-?[0-9]+)", 1)
    captures = assemble(records).select(
        F.when(number != "", number.cast("long")).alias("page_id"),
        "record_id", "refers_to", F.col("type").alias("record_type"), F.col("digest").alias("payload_digest"), "payload_bytes")
    first = captures.filter("record_type = 'response'").select(
        F.col("record_id").alias("of"), F.col("page_id").alias("of_page"), F.col("payload_bytes").alias("of_bytes"))
    own = captures.filter("record_type = 'response'").withColumn("of_page", F.lit(None).cast("long"))
    again = captures.filter("record_type = 'revisit'").join(first, F.col("refers_to") == F.col("of"), "left") \
        .withColumn("payload_bytes", F.col("of_bytes"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", F.col("of_page").alias("refers_to")]
    return own.select(*names).unionByName(again.select(*names))
