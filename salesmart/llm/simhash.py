"""SimHash near-duplicates by pigeonring filtering (operator 3).

Fingerprint: a bit is set if it is set in more than half of the XXH64 hashes (seed 42) of the
word shingles. The 64 bits are cut into m = 2t+1 segments on a ring (t: the distance allowed).
If two fingerprints differ in at most t bits, some segment starts a chain whose first l segments
differ in at most floor(l*t/m) bits for every l. The first two segments of such a chain are
therefore equal, and of the next two (t >= 2) at least one is: fingerprints are dealt by
those segments' bits, and the chain test prunes pairs before the full Hamming check.

Equal fingerprints are one node, so copies are never paired. A dealt bucket is compared in
numpy and leaves as a spanning forest of its links, not as pairs; a bucket over
``PAIRWISE`` looks up each difference that the chain allows instead, which takes time linear
in its size. A bucket over ``LARGE`` isn't compared as one: what its fingerprints may still differ in is cut into t+1
parts, of which two linked ones share at least one, and they are dealt anew by each part. Fingerprints
are distinct, so at t = 2 such a bucket holds at most 2^18 of them whatever the data. Links then go through ``components``.

Defined results: null and empty texts and texts of white space alone have fingerprint zero,
linked like any other; texts of fewer words than a shingle have one shingle, the whole
sequence; every row gives one row; a null doc_id never names a component unless all its ids are
null. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import arrow_map, shared, whole
from salesmart.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
CHUNK = 1 << 15            # shingles whose bits are unpacked at once
PAIRWISE = 4096            # bucket size up to which all its pairs are compared
BUFFER = 1 << 16           # dealt rows looked at together
LARGE = 1 << 18            # bucket size, beyond the mean of a bin, from which a bucket is dealt anew
BINS = 1 << 18             # classes of buckets that are counted


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """As a signed 64-bit integer."""
    words = text.encode().lower().split()     # bytes: ASCII letters and white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]  # noqa: B905
    hashes = np.frombuffer(b"".join(map(partial(xxhash.xxh64_digest, seed=SEED), parts)), np.uint8)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        counts += np.unpackbits(hashes[8 * at:8 * (at + CHUNK)]).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key, fp`` of each whole text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["key", "fp"])
    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, whole(text)), run, f"key {kind}, fp long").withColumnRenamed("key", key)


class Ring:
    """Segments, chain budgets and the bits to deal by, for distance t >= 1."""

    def __init__(self, distance: int):
        self.t, self.m = distance, 2 * distance + 1
        cuts = [64 * k // self.m for k in range(self.m + 1)]
        self.segments = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        pick = lambda *ks: sum(self.segments[k % self.m] for k in ks)
        keys = [(i, i + 1, j) for i in range(self.m) for j in (i + 2, i + 3)] if distance > 1 else \
            [(i, i + 1) for i in range(self.m)]
        #: (the chain's first segment, the bits that are equal)
        self.tables = [(k[0], pick(*k)) for k in keys]
        #: number of those; behind them, for each, t+1 finer ones that a large bucket is dealt by instead
        self.coarse = len(self.tables)
        for start, mask in self.tables[:self.coarse]:
            free = [b for b in range(64) if not mask >> b & 1]
            ends = [len(free) * j // (distance + 1) for j in range(distance + 2)]
            self.tables += [(start, mask | sum(1 << b for b in free[lo:hi])) for lo, hi in zip(ends, ends[1:], strict=False)]

    def finer(self, table: int) -> range:
        first = self.coarse + table * (self.t + 1)
        return range(first, first + self.t + 1)

    def chain(self, start: int, diff: np.ndarray) -> np.ndarray:
        """Which differences keep every prefix of the chain from ``start`` within its budget; the last
        prefix is the whole ring, so what is left passes the full Hamming check."""
        ok, total = np.arange(len(diff)), np.zeros(len(diff), np.int64)
        for length in range(1, self.m + 1):
            total = total + np.bitwise_count(diff[ok] & np.uint64(self.segments[(start + length - 1) % self.m]))
            fine = total <= length * self.t // self.m
            ok, total = ok[fine], total[fine]
        return ok

    def differences(self, start: int, mask: int) -> np.ndarray:
        """Every difference outside ``mask`` that passes the chain test."""
        free = [b for b in range(64) if not mask >> b & 1]
        all_of = np.array([sum(1 << b for b in some) for k in range(1, self.t + 1) for some in combinations(free, k)], np.uint64)
        return all_of[self.chain(start, all_of)]


def _links(ring: Ring, table: np.ndarray, bucket: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs within the runs of equal ``table, bucket``."""
    lefts, rights = [], []
    new = (table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1])
    cuts = np.flatnonzero(np.r_[True, new, True])
    group, sizes = np.cumsum(np.r_[0, new]), np.repeat(np.diff(cuts), np.diff(cuts))
    at, shift = np.flatnonzero((sizes > 1) & (sizes <= PAIRWISE)), 1
    while len(at):      # each row against the one ``shift`` further on in its bucket
        at = at[at + shift < len(fp)]
        at = at[group[at] == group[at + shift]]
        diff = fp[at] ^ fp[at + shift]
        for t in np.unique(table[at]):
            own = np.flatnonzero(table[at] == t)
            hit = at[own[ring.chain(ring.tables[t][0], diff[own])]]
            lefts.append(fp[hit])
            rights.append(fp[hit + shift])
        shift += 1
    for k in np.flatnonzero(np.diff(cuts) > PAIRWISE):
        own = np.sort(fp[cuts[k]:cuts[k + 1]])
        for diff in ring.differences(*ring.tables[table[cuts[k]]]):
            other = own ^ diff
            found = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            lefts.append(own[found])
            rights.append(other[found])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links ``a, b`` but the roots, with the least node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while True:
        was = low.copy()
        least = np.minimum(low[i], low[j])
        np.minimum.at(low, i, least)
        np.minimum.at(low, j, least)
        low = np.minimum(low, low[low])
        if (low == was).all():
            break
    child = low != np.arange(len(nodes))
    return nodes[child], nodes[low[child]]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``u, v``: links between the different fingerprints of ``prints`` (fp), enough to connect every two
    that differ in at most ``distance`` bits."""
    if distance < 1:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    ring = Ring(distance)
    dealt = deal(prints, ring)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(parts: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(parts, axis=1)
            a, b = _forest(*_links(ring, rows[0], rows[1], rows[2].view(np.uint64)))
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["u", "v"])
        held, n = [], 0
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            if n >= BUFFER and rows.shape[1]:        # the bucket of the last row may go on, those before it don't
                others = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(0))
                cut = others[-1] + 1 if len(others) else 0
                if cut or (held[-1][:2, -1] != rows[:2, -1]).any():
                    yield found([*held, rows[:, :cut]])
                    held, n, rows = [], 0, rows[:, cut:]
            if rows.shape[1]:
                held.append(rows)
                n += rows.shape[1]
        if n:
            yield found(held)
    return dealt.repartition("t", "bucket").sortWithinPartitions("t", "bucket", "fp").mapInArrow(run, "u long, v long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def deal(prints: DataFrame, ring: Ring) -> DataFrame:
    """``t, bucket, fp``: each fingerprint under the bits of each table, those of large buckets under the finer tables' bits.

    Buckets are counted in ``BINS`` classes, map-side first; every bucket of a class that is over the mean by ``LARGE``
    counts as large, which only costs its fingerprints t more rows. The classes sent to the tasks are at most ``BINS`` numbers.
    """
    under = lambda t: F.col("fp").bitwiseAND(F.lit(_signed(ring.tables[t][1])))
    rows = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), under(t).alias("bucket")) for t in range(ring.coarse)])).alias("x")) \
        .select("x.t", "x.bucket", "fp").withColumn("bin", F.pmod(F.xxhash64("t", "bucket"), F.lit(BINS)))
    counts = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.sum("n").over(Window.partitionBy()))
    large = counts.filter(F.col("n") > F.col("all") / BINS + LARGE).select(F.col("bin").alias("large"))
    marked = rows.join(F.broadcast(large), rows["bin"] == large["large"], "left")
    again = F.coalesce(*(F.when(F.col("t") == t, F.array(*(
        F.struct(F.lit(u).alias("t"), under(u).alias("bucket")) for u in ring.finer(t)))) for t in range(ring.coarse)))
    same = F.array(F.struct(F.col("t"), F.col("bucket")))
    return marked.select("fp", F.explode(F.when(F.col("large").isNull(), same).otherwise(again)).alias("x")) \
        .select("x.t", "x.bucket", "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """``key, fp, component_id`` per row: the least key reachable over links of at most ``distance`` bits."""
    prints = shared(fingerprints(docs, key, text, shingle), "prints")
    nodes = prints.groupBy("fp").agg(F.min(key).alias("first"))
    roots = components(links(nodes.select("fp"), distance))
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    least = members.join(nodes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first").alias("least"))
    named = nodes.join(members.join(least, "root").select(F.col("node").alias("fp"), "least"), "fp", "left") \
        .select("fp", F.coalesce("least", "first").alias("component_id"))
    # written first, so that both sides of the join are dealt for it alone and AQE can split a hot fingerprint's rows
    return prints.join(shared(named, "named"), "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the one of the least key. Rows that
    share a key are told apart by their text; those that share both go or stay together."""
    mine = docs.withColumn("__llm_row", F.struct(F.col(key).alias("id"), F.xxhash64(whole(text)).alias("hash")))
    found = near_duplicates(mine, "__llm_row", text, shingle, distance)
    gone = found.filter(F.col("__llm_row") != F.col("component_id")).select(F.col("__llm_row").alias("gone")).distinct()
    return mine.join(gone, mine["__llm_row"] == gone["gone"], "left_anti").drop("__llm_row")


def simhash_components(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op3``."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
