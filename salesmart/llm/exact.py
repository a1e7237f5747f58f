"""Exact dedup through a cuckoo-filter index (operator 1).

Texts are equal when identical after lower-casing A-Z. Their SHA-256 digests go through
``CuckooIndex`` twice: each input partition indexes its own rows (so a text with any number of
copies leaves it as one entry), then the entries meet in partitions dealt by digest and are
indexed again. A filter hit only counts once the digest stored in the bucket agrees, an
insertion that finds no room makes the filter resize from the stored digests, and digests
can be deleted from the live set. The index is a table that later runs can extend.

Defined results: a null text is an empty one; of equal texts the row of the largest doc_id
stays, a null doc_id being below any other; repeated rows (same doc_id, equal text) count
in group_size and are one document: all are marked kept in ``groups``, and ``keep_one`` keeps one
of them. Texts are hashed whole. Columns other than doc_id and the text are not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import ascii_lower, shared, whole

SLOTS = 4                  # a bucket
KICKS = 200                # moves before the filter resizes
LOCAL_KEYS = 200_000       # live digests that an input partition indexes before it hands them on
PARTITION_KEYS = 500_000   # digests that a dealt partition gets on average, at most
INDEX = "digest binary, keep_id long, copies long, keep_rows long"


class CuckooIndex:
    """Live digests: a cuckoo filter of 16-bit tags whose slots point at the stored keys."""

    def __init__(self, buckets: int = 256):
        self.keys: list[bytes | None] = []
        self.entries: list[tuple] = []       # (keep_id, copies, keep_rows) of each key
        self.free: list[int] = []
        self.live = 0
        self._room(buckets)

    def _room(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = array("H", bytes(2 * SLOTS * buckets))     # 0: empty
        self.refs = array("l", bytes(8 * SLOTS * buckets))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return tag, first, first ^ (tag * 0x5BD1E995 & self.mask)

    def slot(self, digest: bytes) -> int:
        """The slot of a live digest, else -1. Equal tags only propose; the stored key decides."""
        tag, a, b = self._places(digest)
        for bucket in (a, b):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.tags[s] == tag and self.keys[self.refs[s]] == digest:
                    return s
        return -1

    def _place(self, tag: int, bucket: int, other: int, ref: int) -> bool:
        for start in (bucket, other):
            for s in range(start * SLOTS, start * SLOTS + SLOTS):
                if not self.tags[s]:
                    self.tags[s], self.refs[s] = tag, ref
                    return True
        at = other
        for kick in range(KICKS):
            s = at * SLOTS + (kick + ref) % SLOTS
            tag, self.tags[s] = self.tags[s], tag
            ref, self.refs[s] = self.refs[s], ref
            at ^= tag * 0x5BD1E995 & self.mask
            for s in range(at * SLOTS, at * SLOTS + SLOTS):
                if not self.tags[s]:
                    self.tags[s], self.refs[s] = tag, ref
                    return True
        return False

    def _resize(self) -> None:
        """A filter of twice the buckets, from the stored keys; the key that found no room is among them."""
        while True:
            self._room(2 * (self.mask + 1))
            if all(k is None or self._place(*self._places(k), ref) for ref, k in enumerate(self.keys)):
                return

    def insert(self, digest: bytes, keep_id: int | None, copies: int = 1, keep_rows: int = 1) -> None:
        at = self.slot(digest)
        if at >= 0:
            ref = self.refs[at]
            best, n, rows = self.entries[ref]
            if best == keep_id:
                rows += keep_rows
            elif best is None or keep_id is not None and keep_id > best:
                best, rows = keep_id, keep_rows
            self.entries[ref] = (best, n + copies, rows)
            return
        if self.free:
            ref = self.free.pop()
            self.keys[ref], self.entries[ref] = digest, (keep_id, copies, keep_rows)
        else:
            ref = len(self.keys)
            self.keys.append(digest)
            self.entries.append((keep_id, copies, keep_rows))
        self.live += 1
        if not self._place(*self._places(digest), ref):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        at = self.slot(digest)
        if at < 0:
            return False
        ref = self.refs[at]
        self.tags[at], self.keys[ref], self.entries[ref] = 0, None, (None, 0, 0)
        self.free.append(ref)
        self.live -= 1
        return True

    def batches(self, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
        live = [i for i, k in enumerate(self.keys) if k is not None]
        for at in range(0, len(live), rows):
            part = live[at:at + rows]
            keep, copies, same = zip(*(self.entries[i] for i in part), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.keys[i] for i in part], pa.binary()), pa.array(keep, pa.int64()),
                 pa.array(copies, pa.int64()), pa.array(same, pa.int64())],
                ["digest", "keep_id", "copies", "keep_rows"])


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for digest, doc_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            index.insert(digest, doc_id)
        if index.live >= LOCAL_KEYS:
            yield from index.batches()
            index = CuckooIndex()
    yield from index.batches()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, retired = CuckooIndex(), []
    for batch in batches:
        for digest, keep_id, copies, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if copies < 0:
                retired.append(digest)
            else:
                index.insert(digest, keep_id, copies, rows)
    for digest in retired:
        index.delete(digest)
    yield from index.batches()


def digest(text: str = "text"):
    return F.unhex(F.sha2(ascii_lower(whole(text)).cast("binary"), 256))


def live_index(digests: DataFrame, index: DataFrame | None = None, retired: DataFrame | None = None) -> DataFrame:
    """``INDEX`` rows, one for each live digest: those of ``digests`` (digest, doc_id) and of an earlier
    ``index``, less the ``retired`` ones (digest)."""
    spark = digests.sparkSession
    rows = digests.count()
    entries = digests.select("digest", "doc_id").mapInArrow(_local, INDEX)
    if index is not None:
        rows += index.count()
        entries = entries.unionByName(index)
    if retired is not None:
        gone = F.lit(-1).cast("long")
        entries = entries.unionByName(retired.select("digest", F.lit(None).cast("long").alias("keep_id"),
                                                     gone.alias("copies"), gone.alias("keep_rows")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_KEYS))
    return entries.repartition(parts, "digest").mapInArrow(_merged, INDEX)


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept, keep_rows."""
    digests = shared(docs.select(F.col(key).cast("long").alias("doc_id"), digest(text).alias("digest")), "digests")
    index = live_index(digests)
    return digests.join(index, "digest").select(
        "doc_id", "digest", "keep_id", F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "keep_rows")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    found = shared(groups(docs, key, text), "exact")
    mine = docs.withColumns({"__llm_id": F.col(key).cast("long"), "__llm_digest": digest(text)})
    same = lambda d: mine["__llm_id"].eqNullSafe(d["doc_id"]) & (mine["__llm_digest"] == d["digest"])
    gone = found.filter(~F.col("kept")).select("doc_id", "digest")
    kept = mine.join(gone, same(gone), "left_anti")
    again = found.filter("kept and keep_rows > 1").select("doc_id", "digest").distinct()
    if not again.isEmpty():      # of repeated rows, one
        once = mine.join(again, same(again), "left_semi").dropDuplicates(["__llm_id", "__llm_digest"])
        kept = kept.join(again, same(again), "left_anti").unionByName(once)
    return kept.drop("__llm_id", "__llm_digest")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op1``."""
    return groups(docs).select("doc_id", "keep_id", "group_size", "kept",
                               F.lower(F.hex("digest")).alias("text_sha256"))
