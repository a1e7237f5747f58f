"""Sharding by best-fit-decreasing bin packing (operator 7).

Groups (equal texts) are indivisible. Packing takes two levels, so that no task and no driver
holds all groups: each lot (a hash range of the groups, sorted by size, streamed) packs its
groups into crates of a 256th of a shard, then the crates, whose number the total size bounds, are packed
into the shards. Both levels put each item into the bin of the tightest sufficient room, found
in a balanced tree of the open bins. The second level takes the least capacity that
does with the given number of shards; a group larger than an even share gets a shard alone.

Defined results: a null text has no bytes and is in the group of empty texts; every row gives one
row, repeated rows too; a null doc_id comes first in its shard's order; an empty table gives an empty
result. Columns other than doc_id and the text are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesmart.llm.common import shared, whole

SHARDS = 40
ROW_BYTES = 16              # beside the text
CRATES = 256                # to a shard
MAX_LOTS = 4096
LOT_GROUPS = 100_000        # a lot, until there are MAX_LOTS
SLOT_ROWS = 100_000         # numbered together


class RoomTree:
    """Open bins by ``(room, bin)``: a treap."""

    def __init__(self):
        self.root, self.random = None, random.Random(7)

    def insert(self, room: int, name: int) -> None:
        """Node: [room, bin, priority, left, right]."""
        low, high = self._split(self.root, (room, name))
        self.root = self._merge(self._merge(low, [room, name, self.random.random(), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin of least sufficient room."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node, above = high, None
        while node[3] is not None:
            node, above = node[3], node
        if above is None:
            high = node[4]
        else:
            above[3] = node[4]
        self.root = self._merge(low, high)
        return node[0], node[1]

    def _split(self, node, at: tuple[int, int]):
        if node is None:
            return None, None
        if (node[0], node[1]) < at:
            node[4], rest = self._split(node[4], at)
            return node, rest
        rest, node[3] = self._split(node[3], at)
        return rest, node

    def _merge(self, a, b):
        if a is None or b is None:
            return b if a is None else a
        if a[2] > b[2]:
            a[4] = self._merge(a[4], b)
            return a
        b[3] = self._merge(a, b[3])
        return b


def best_fit(sizes: Iterable[int], capacity: int) -> Iterator[int]:
    """The bin of each item; sizes come in decreasing order. An item over the capacity gets a bin alone."""
    tree, bins = RoomTree(), 0
    for size in sizes:
        found = tree.take(size)
        room, name = found or (capacity, bins)
        bins += found is None
        if room > size:
            tree.insert(room - size, name)
        yield name


def pack(sizes: list[int], shards: int) -> list[int]:
    """Shards of items in decreasing order of size, with the least capacity that does."""
    out, free, left, k = [], shards, sum(sizes), 0
    while k < len(sizes) and free > 1 and sizes[k] * free > left:     # larger than an even share of the rest
        out.append(k)
        left, free, k = left - sizes[k], free - 1, k + 1
    rest = sizes[k:]
    if not rest:
        return out
    low, high = max(rest[0], -(-left // free)), max(rest[0], -(-left // free)) + rest[0]
    fits = lambda c: max(best_fit(rest, c)) < free
    while not fits(high):
        high *= 2
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return out + [k + name for name in best_fit(rest, low)]


def assign(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``group, shard`` for ``groups`` (group binary, size long; a written table)."""
    total, n = groups.agg(F.sum("size"), F.count("*")).first()
    capacity = -(-(total or 0) // (shards * CRATES)) or 1
    lots = min(MAX_LOTS, max(1, -(-n // LOT_GROUPS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def sizes():
            for batch in batches:
                held.append(batch)
                yield from batch.column(1).to_pylist()
        names, lot, found = best_fit(sizes(), capacity), TaskContext.get().partitionId(), []
        for name in names:
            found.append(lot << 32 | name)
            if len(found) == held[0].num_rows:      # a batch is placed before the next is read
                batch = held.pop(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["group", "size", "crate"])
                found = []
    crated = shared(groups.select("group", "size").repartition(lots, "group")
                    .sortWithinPartitions(F.desc("size"), "group").mapInArrow(run, "group binary, size long, crate long"), "crates")
    # at most 2 * shards * CRATES + lots rows, whatever the input
    crates = sorted(((-r[1], r[0]) for r in crated.groupBy("crate").agg(F.sum("size")).collect()))
    shard_of = pack([-s for s, _ in crates], shards)
    placed = groups.sparkSession.createDataFrame([(c, s) for (_, c), s in zip(crates, shard_of, strict=True)], "crate long, shard int")
    return crated.join(placed, "crate").select("group", "shard")


def parts(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``__part`` and ``__rows``: each row's copies as entries of at most ``SLOT_ROWS``, dealt by hash into parts of about
    as many, so that neither a shard nor a row that is repeated without end is numbered as one."""
    total = rows.agg(F.sum("copies")).first()[0] or 0
    n = max(1, -(-total // SLOT_ROWS))
    cut = rows.withColumn("__entry", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SLOT_ROWS))))
    return cut.withColumn("__rows", F.least(F.lit(SLOT_ROWS).cast("long"), F.col("copies") - F.col("__entry") * SLOT_ROWS)) \
        .withColumn("__part", F.pmod(F.xxhash64(*order, "__entry"), F.lit(n)).cast("int"))


def slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (a written table of distinct rows with ``shard`` and ``copies``) once for each copy, with ``slot``, gapless from 0 in
    each shard. A shard's rows are numbered in ``parts``; the parts' counts give their first slots."""
    cut = parts(rows, order)
    counts = cut.groupBy("shard", "__part").agg(F.sum("__rows").alias("n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    own = F.sum("__rows").over(Window.partitionBy("shard", "__part").orderBy(*order, "__entry").rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("__first") + F.coalesce(F.col("__own"), F.lit(0))
    return cut.withColumn("__own", own).join(first, ["shard", "__part"]) \
        .withColumn("slot", F.explode(F.sequence(start, start + F.col("__rows") - 1))) \
        .drop("__part", "__first", "__own", "__entry", "__rows", "copies")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Contract columns of ``op7`` under the law ``bytes``."""
    body = whole("text").cast("binary")
    rows = docs.select("doc_id", (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("group"))
    # repeated rows leave a map task as one
    rows = shared(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "sizes")
    groups = shared(rows.groupBy("group").agg(F.sum(F.col("size") * F.col("copies")).alias("size")), "groups")
    placed = shared(rows.join(assign(groups, shards), "group"), "placed")
    return slots(placed, ["doc_id", "group"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
