"""Byte-level BPE, encoding and decoding (operator 10).

A piece's adjacent pairs are the leaves of a segment tree whose nodes hold the smallest
``rank, position``: the root is the leftmost pair of lowest rank. A merge rewrites three leaves
(the pair, the pair to its left, the pair that went) and their paths to the root, so a piece of
n bytes takes O(n log n), however long it is. A batch's new short pieces go through their trees
side by side in numpy, a tree a row; long ones one by one. The vocabulary file's path is a parameter.

Defined results: null and empty texts have no tokens and decode to the empty text; every row
gives one row, repeated rows too; texts are never cut; columns other than the named ones are
not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import arrow_map, whole

#: Fixed value: the pre-tokenizer's pattern.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_FILE_BYTES = 64 << 20      # of a vocabulary that is broadcast
CACHED_PIECES = 400_000        # of one Python worker; pieces beyond start the cache anew
SHORT = (8, 16, 32)            # bytes of the pieces that go side by side; longer ones aren't cached
_NONE = 1 << 62
_POSITION = (1 << 40) - 1


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: bytes):
        spec = json.loads(spec)
        model, symbols = spec["model"], byte_symbols()
        vocab = model["vocab"]
        self.bytes_of = {i: bytes(symbols[c] for c in t) for t, i in vocab.items()}
        of_byte = {b: i for i, b in self.bytes_of.items() if len(b) == 1}
        self.first = [of_byte[bytes([b])] for b in range(256)]
        self.rank, self.made = {}, []
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a] << 20 | vocab[b]] = r << 40
            self.made.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        by_length = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        self.pieces = regex.compile(PIECES).findall
        self.cache: dict[str, bytes] = {}
        by_key = sorted(self.rank)
        self.keys = np.array(by_key, np.int64)
        self.ranks = np.array([self.rank[k] for k in by_key], np.int64)
        self.first_ids, self.made_ids = np.array(self.first, np.int64), np.array(self.made, np.int64)

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one piece."""
        first, rank = self.first, self.rank.get
        ids = [first[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        tree = [_NONE] * (2 * size)
        some = False
        for i in range(n - 1):
            r = rank(ids[i] << 20 | ids[i + 1])
            if r is not None:
                tree[size + i] = r | i
                some = True
        if not some:
            return ids
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != _NONE:
            i = root & _POSITION
            j = right[i]
            k = right[j]
            ids[i] = made = self.made[root >> 40]
            ids[j] = -1
            right[i] = k
            changed = [(j, _NONE)] if j < n - 1 else []
            if k < n:
                left[k] = i
                r = rank(made << 20 | ids[k])
                changed.append((i, _NONE if r is None else r | i))
            else:
                changed.append((i, _NONE))
            h = left[i]
            if h >= 0:
                r = rank(ids[h] << 20 | made)
                changed.append((h, _NONE if r is None else r | h))
            for leaf, value in changed:
                at = size + leaf
                tree[at] = value
                while at > 1:      # up to the first node that stays as it was
                    sibling = tree[at ^ 1]
                    at >>= 1
                    low = value if value < sibling else sibling
                    if tree[at] == low:
                        break
                    tree[at] = value = low
        return [i for i in ids if i >= 0]

    def _ranked(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves for the pairs ``a, b`` at positions ``at``."""
        key = a << 20 | b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.ranks[i] | at, _NONE)

    def merge_many(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Packed ids of pieces of at most ``size`` (a power of two) bytes: ``merge`` on many trees at once."""
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        at = np.arange(size)
        inside = at < n[:, None]
        ids = np.full(inside.shape, -1, np.int64)
        ids[inside] = self.first_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        tree = np.full((len(n), 2 * size), _NONE, np.int64)
        tree[:, size:-1] = np.where(inside[:, 1:], self._ranked(ids[:, :-1], ids[:, 1:], at[:-1]), _NONE)
        width = size
        while width > 1:
            tree[:, width // 2:width] = np.minimum(tree[:, width:2 * width:2], tree[:, width + 1:2 * width:2])
            width //= 2
        right, left = np.tile(at + 1, (len(n), 1)), np.tile(at - 1, (len(n), 1))
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root = tree[rows, 1]
            i, made = root & _POSITION, self.made_ids[root >> 40]
            j = right[rows, i]
            k = right[rows, j]
            ids[rows, i], ids[rows, j], right[rows, i] = made, -1, k
            more, h = k < n[rows], left[rows, i]
            left[rows[more], k[more]] = i[more]
            follows, before = np.minimum(k, size - 1), np.maximum(h, 0)
            tree[rows, size + j] = _NONE
            tree[rows, size + i] = np.where(more, self._ranked(made, ids[rows, follows], i), _NONE)
            first = h < 0
            tree[rows, size + before] = np.where(first, tree[rows, size + before],
                                                 self._ranked(ids[rows, before], made, before))
            for leaf in (j, i, before):
                node = size + leaf >> 1
                while node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node = node >> 1
            rows = rows[tree[rows, 1] != _NONE]
        kept = ids >= 0
        packed, ends = ids[kept].astype("<u4").tobytes(), 4 * np.cumsum(kept.sum(1))
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def learn(self, pieces: set[str]) -> None:
        """Put the pieces that are short enough into the cache."""
        new = [(p, b) for p in pieces.difference(self.cache) if len(b := p.encode()) <= SHORT[-1]]
        if len(self.cache) + len(new) > CACHED_PIECES:
            self.cache.clear()
            new = [(p, b) for p in pieces if len(b := p.encode()) <= SHORT[-1]]
        least = 0
        for size in SHORT:
            some = [x for x in new if least < len(x[1]) <= size]
            for k in range(0, len(some), 8192):
                part = some[k:k + 8192]
                self.cache.update(zip([p for p, _ in part], self.merge_many([b for _, b in part], size), strict=True))
            least = size

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's token ids as little-endian unsigned 32-bit integers."""
        parts = [self.cut.split(t) if self.cut else [t] for t in texts]     # odd ones are added tokens
        pieces = [[None if k % 2 else self.pieces(part) for k, part in enumerate(own)] for own in parts]
        self.learn({p for own in pieces for some in own[::2] for p in some})
        known = self.cache.get
        return [b"".join(_packed([self.added[part]]) if some is None else
                         b"".join([known(p) or _packed(self.merge(p.encode())) for p in some])
                         for part, some in zip(own, found, strict=True))
                for own, found in zip(parts, pieces, strict=True)]

    def decode(self, packed: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(packed).cast("I"))).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


_codecs: dict[str, Codec] = {}


def _codec(key: str, spec) -> Codec:
    """One codec a Python worker, kept between its tasks."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(spec.value)
    return _codecs[key]


def _spec(df: DataFrame, path: str | None):
    path = path or default_path()
    if (size := os.path.getsize(path)) > MAX_FILE_BYTES:
        raise ValueError(f"{path}: {size} bytes, at most {MAX_FILE_BYTES} are broadcast")
    with open(path, "rb") as f:
        raw = f.read()
    return hashlib.sha256(raw).hexdigest(), df.sparkSession.sparkContext.broadcast(raw)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key, ids``: the token ids of each whole text, packed as little-endian unsigned 32-bit integers."""
    name, spec = _spec(df, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(name, spec)
        ids = codec.encode_batch(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["key", "ids"])
    kind = df.schema[key].dataType.simpleString()
    return arrow_map(df.select(key, whole(text)), run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``key, ids, decoded``: the text that packed ``ids`` stand for; bytes that aren't UTF-8 become U+FFFD."""
    name, spec = _spec(df, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(name, spec)
        texts = [codec.decode(x) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                          ["key", "ids", "decoded"])
    kind = df.schema[key].dataType.simpleString()
    empty = F.coalesce(F.col(ids), F.lit(b""))
    return arrow_map(df.select(key, empty), run, f"key {kind}, ids binary, decoded string").withColumnRenamed("key", key)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Contract columns of ``op10``: both digests come from the operator's ids and decoded texts."""
    out = decode(encode(docs, path=path), path=path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
