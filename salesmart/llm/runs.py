"""Periodic runs of words (operator 11).

A run is a stretch of consecutive words with smallest period q, at least max(``least``, 2q) words long, that no
neighbouring word extends keeping period q. If a run of length n and period q starts at s, the suffixes at s and s + q
agree in exactly n - q words, and no position between them agrees with s in as many. So the suffixes' classes are
united by decreasing length of their common prefixes (descending-LCP Kruskal over the suffix array's neighbours), each
class holding its positions in order, and two positions that become neighbours at a distance within the common prefix
seed a run: its start, if the words before the two differ. Common prefixes shorter than half of ``least`` can't seed one, which
leaves all but the repetitive texts out before any suffix is sorted.

A text's work is O(n log n) sorting in numpy and a few small steps for each position whose next ``least / 2`` words
recur in the text; memory is four bytes a word for each doubling of the longest repeat. Texts are independent, so
nothing is shuffled; a batch's texts are searched together.

Defined results: null, empty and blank texts have no words and no runs; texts are never cut; every row gives one
row, repeated rows too; a null key is kept, and ``plant`` leaves its text as it is; an empty table gives no rows;
columns other than the named ones are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import arrow_map, whole

#: Fixed values of the contract: words end at these characters; a run has at least 12 words.
SPACES = r"[\x20\x09-\x0D]+"
LEAST = 12
WORDS_AT_ONCE = 1 << 20        # of texts that are searched together; a longer text goes alone
BLOCK = 1024                   # positions a block of a large class holds before it is split
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Positions:
    """An ordered set of positions, in blocks, so that inserting stays cheap in a class of millions."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, position: int):
        self.blocks, self.heads, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def neighbours(self, p: int) -> tuple[int, int]:
        """The positions before and after ``p``, which isn't in the set; -1 where there is none."""
        k = max(bisect_left(self.heads, p) - 1, 0)
        block = self.blocks[k]
        i = bisect_left(block, p)
        after = block[i] if i < len(block) else self.heads[k + 1] if k + 1 < len(self.heads) else -1
        return block[i - 1] if i else -1, after

    def add(self, p: int) -> None:
        k = max(bisect_left(self.heads, p) - 1, 0)
        block = self.blocks[k]
        insort(block, p)
        self.heads[k] = block[0]
        self.size += 1
        if len(block) > BLOCK:
            half = block[BLOCK // 2:]
            del block[BLOCK // 2:]
            self.blocks.insert(k + 1, half)
            self.heads.insert(k + 1, half[0])


def _dense(key: np.ndarray) -> tuple[np.ndarray, int]:
    values, rank = np.unique(key, return_inverse=True)
    return rank.astype(np.int64), len(values)


def _doubled(rank: np.ndarray, step: int, ahead: int) -> tuple[np.ndarray, int]:
    """Ranks of the ``step + ahead`` words (at most twice ``step``) from each position, from those of ``step`` words."""
    later = np.zeros_like(rank)
    later[:-ahead] = rank[ahead:] + 1
    return _dense(rank * (len(rank) + 2) + later)


def _recurring(code: np.ndarray, least: int) -> np.ndarray:
    """Whether the ``least`` words from each position occur at another one too."""
    rank, step = _dense(code)[0], 1
    while step < least:
        ahead = min(step, least - step)
        rank = _doubled(rank, step, ahead)[0]
        step += ahead
    return np.bincount(rank)[rank] > 1


def _suffixes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the length of the common prefix of each suffix and the next one."""
    levels: list[np.ndarray] = []
    rank, n = _dense(code)
    while n < len(code):
        levels.append(rank.astype(np.int32))
        rank, n = _doubled(rank, 1 << len(levels) - 1, min(1 << len(levels) - 1, len(code)))
    order = np.empty(len(code), np.int64)
    order[rank] = np.arange(len(code))
    at, to = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][at] == levels[k][to]
        at[same] += 1 << k
        to[same] += 1 << k
    return order, at - order[:-1]


def _seeds(code: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """``start, length, period`` of every run in ``code``, whose texts each end in a word of their own."""
    order, common = _suffixes(code)
    shortest = (least + 1) // 2
    edges = np.flatnonzero(common >= shortest)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    if not len(edges):
        return
    parent = {e: e for i in edges.tolist() for e in (i, i + 1)}
    place = {e: p for e, p in zip(parent, order[list(parent)].tolist(), strict=True)}
    members = {e: _Positions(p) for e, p in place.items()}
    words = code.tolist()

    def root(e: int) -> int:
        while parent[e] != e:
            parent[e] = e = parent[parent[e]]
        return e
    for e, lcp in zip(edges.tolist(), common[edges].tolist(), strict=True):
        a, b = root(e), root(e + 1)
        if members[a].size < members[b].size:
            a, b = b, a
        large, small = members[a], members.pop(b)
        parent[b] = a
        inserted = list(small)
        for k, p in enumerate(inserted):
            before, after = large.neighbours(p)      # ``large`` holds the smaller ones of ``inserted`` already
            pairs = []
            if before >= 0 and not (k and before == inserted[k - 1]):
                pairs.append((before, p))
            if after >= 0 and not (k + 1 < len(inserted) and inserted[k + 1] < after):
                pairs.append((p, after))
            for s, t in pairs:
                period = t - s
                if period <= lcp and period + lcp >= least and (s == 0 or words[s - 1] != words[t - 1]):
                    yield s, period + lcp, period
            large.add(p)


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of each text's runs, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    group: list[int] = []
    held = 0

    def search() -> None:
        flat = [w for k in group for w in texts[k]]
        word = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.array([len(texts[k]) for k in group])
        kinds = int(word.max(initial=0)) + 2
        own = np.repeat(np.arange(len(group)), sizes)
        ends = np.cumsum(sizes)
        # words of different texts differ, and each text ends in a word that occurs once
        code = np.insert(own * kinds + word, ends, np.arange(len(group)) * kinds + kinds - 1)
        own, starts = np.repeat(np.arange(len(group)), sizes + 1), ends - sizes + np.arange(len(group))
        some = np.zeros(len(group), bool)
        some[own[_recurring(code, (least + 1) // 2)]] = True
        if not some.any():
            return
        kept = np.flatnonzero(some[own])
        for s, length, period in _seeds(code[kept], least):
            text = own[kept[s]]
            found[group[text]].append((int(kept[s] - starts[text]), length, period))
    for k, words in enumerate(texts):
        if len(words) < least:
            continue
        if group and held + len(words) > WORDS_AT_ONCE:
            search()
            group, held = [], 0
        group.append(k)
        held += len(words)
    if group:
        search()
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(w for w, inside in zip(words, np.cumsum(edge).tolist(), strict=False) if not inside)


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``key, runs, collapsed``: each whole text's runs, as an array of ``start, length, period`` by start, then period, and
    the text with each run cut to its first period and words joined by one space."""
    if least < 2:
        raise ValueError("a run has at least two words")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        # bytes.split() cuts at the space and U+0009 to U+000D, and nowhere else
        texts = [t.split() for t in batch.column(1).to_pylist()]
        runs = find_runs(texts, least)
        flat = [r for x in runs for r in x]
        columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(RUN)))
        cut = [_collapsed(w, r).decode() for w, r in zip(texts, runs, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(cut, pa.string())], ["key", "runs", "collapsed"])
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return arrow_map(df.select(F.col(f"`{key}`"), whole(F.col(f"`{text}`")).cast("binary")), run, schema).withColumnRenamed("key", key)


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the tail of every tenth document (by crc32 of its id) made periodic, as the contract states."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(whole("text"), SPACES), lambda w: w != "")
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def word(i: Column) -> Column:
        return F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    tail = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", word(i))), " ")
    rows = docs.select("doc_id", "text", h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), tail).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op11``, all from the operator's runs and collapsed texts."""
    found = periodic_runs(plant(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("from_end"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.short")
    return best.select("doc_id", "n_runs", (-F.col("best.from_end")).alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
