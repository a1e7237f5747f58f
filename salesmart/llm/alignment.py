"""Cross-tokenizer alignment over distinct texts (operator 13).

The rows are shuffled by their full text, each distinct text is tokenised by both vocabularies and aligned once, and
its pairs count as often as the text occurs. Byte offsets where tokens of both sides end cut them into groups; every
A token of a group is linked with every B token of it. The distinct texts of a task go in chunks of bounded size: a
chunk is one row that holds its distinct pairs of ids once, with the copies of the texts that hold them, and each
text's pairs as places in that list. So what is shuffled for the corpus-wide counts, and back, is a chunk's
distinct pairs and not every text's; a pair or an A id that all chunks hold is added up before the shuffle, and joined
by exchanges that AQE can split. A chunk's counts come back to it by its name, the sha256 of its first text, and its
texts' measures are joined to the rows by the text's sha256.

Groups of ``WIDE`` links or more (in a text whose tokens never end together) are counted by distinct ids, so a text's
memory grows with its tokens and distinct pairs, not with the product of a group's sides.

Defined results: texts that are null, empty or not the joined bytes of both sides' tokens have no tokens, and count
nowhere; special tokens' strings are plain text; every row gives one row, repeated rows and null keys too; texts are
never cut; an empty table gives no rows; columns other than the named ones are not read. Vocabulary files' paths are
parameters.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.bpe import PIECES, _spec, byte_symbols
from salesmart.llm.bpe import default_path as default_a
from salesmart.llm.common import shared, whole

CHUNK_TEXTS, CHUNK_BYTES = 1024, 4 << 20      # a longer text is a chunk of its own
BLOCK_TEXTS = 32                              # of a chunk that are aligned at a time
WIDE = 1 << 12                                # links of a group from which its distinct ids are counted
CHUNK = ("chunk string, sha array<binary>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
         "groups_sha256 array<string>, pairs array<struct<a:int,b:int,copies:bigint>>, ends array<bigint>, places binary, times binary")
MEASURES = ("sha binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def default_b() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Side:
    """One vocabulary: ids of texts, and each id's bytes."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes_of = token_bytes
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)


class ByteLevel(Side):
    """Byte-level BPE of a JSON vocabulary, whose ids are its merges' ranks."""

    def __init__(self, spec: bytes):
        spec, symbols = json.loads(spec), byte_symbols()
        vocab = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items()
                 if i not in {x["id"] for x in spec.get("added_tokens") or []}}
        super().__init__([b for b, _ in sorted(vocab.items(), key=lambda x: x[1])])
        if sorted(vocab.values()) != list(range(len(vocab))):
            raise ValueError("ids of a byte-level vocabulary have to be ranks, without gaps")
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=vocab, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + t).astype(np.int64) for t in texts]


class Pieces(Side):
    """A sentencepiece model, which adds the space before a text itself."""

    def __init__(self, spec: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=spec)
        piece = self.model.id_to_piece
        super().__init__([bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode()
                          for i in range(self.model.get_piece_size())])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


_sides: dict[tuple[str, str], tuple[Side, Side]] = {}


def _both(names: tuple[str, str], a, b) -> tuple[Side, Side]:
    """One pair of vocabularies a Python worker, kept between its tasks."""
    if names not in _sides:
        _sides.clear()
        _sides[names] = ByteLevel(a.value), Pieces(b.value)
    return _sides[names]


def pack(numbers: np.ndarray) -> bytes:
    """Integers from 0 on: how many bytes the greatest one needs, then that many planes of bytes."""
    width = max((int(numbers.max(initial=0)).bit_length() + 7) // 8, 1)
    return bytes([width]) + numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :packed[0]] = planes.T
    return out.view("<i8").ravel()


def _links(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``group, a, b, times`` of all links: one by one, and by distinct ids in groups of very many."""
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = np.flatnonzero(n_a * n_b >= WIDE)
    reach = n_b.copy()
    reach[wide] = 0
    each = reach[of_a]
    at = np.repeat(np.arange(len(a)), each)
    to = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each) + first_b[of_a[at]]
    out = [(of_a[at], a[at], b[to], np.ones(len(at), np.int64))]
    for g in wide.tolist():
        left, times_left = np.unique(a[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
        right, times_right = np.unique(b[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
        out.append((np.full(len(left) * len(right), g), np.repeat(left, len(right)), np.tile(right, len(left)),
                    np.outer(times_left, times_right).ravel()))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


class Aligner:
    """Chunks of aligned texts, ``BLOCK_TEXTS`` at a time."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.some = max(len(a.bytes_of), len(b.bytes_of))
        self.written = np.array([f"{i}{end}" for end in (",", "|", ";", "") for i in range(self.some)], object)

    def chunk(self, shas: list[bytes], texts: list[str], copies: list[int]) -> dict | None:
        """One row of ``CHUNK``; texts that aren't the bytes of their tokens are left out, and None if all are."""
        kept, blocks = [], []
        for k in range(0, len(texts), BLOCK_TEXTS):
            part = texts[k:k + BLOCK_TEXTS]
            a, b = self.a.encode(part), self.b.encode(part)
            own = [i for i, t in enumerate(part)
                   if b"".join(map(self.a.bytes_of.__getitem__, a[i].tolist())) == (want := b" " + t.encode())
                   and b"".join(map(self.b.bytes_of.__getitem__, b[i].tolist())) == want]
            if own:
                blocks.append(self._block([a[i] for i in own], [b[i] for i in own], len(kept)))
                kept += [k + i for i in own]
        if not kept:
            return None
        digests = [x for block in blocks for x in block.pop()]
        n_a, n_b, n_groups, n_links, text, pair, times = map(np.concatenate, zip(*blocks, strict=True))
        pairs, place = np.unique(pair, return_inverse=True)
        weight = np.zeros(len(pairs), np.int64)
        np.add.at(weight, place, np.array([copies[k] for k in kept], np.int64)[text])
        kinds = len(self.b.bytes_of)
        return {"chunk": hashlib.sha256(texts[0].encode()).hexdigest(), "sha": [shas[k] for k in kept],
                "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests,
                "pairs": (pairs // kinds, pairs % kinds, weight), "ends": np.cumsum(np.bincount(text, minlength=len(kept))),
                "places": pack(place), "times": pack(times)}

    def _block(self, a: list[np.ndarray], b: list[np.ndarray], first: int) -> list:
        """Counts of some texts, numbered from ``first``; their distinct pairs as text, pair and links; their groups' digests."""
        n_a, n_b = np.array(list(map(len, a)), np.int64), np.array(list(map(len, b)), np.int64)
        a, b = np.concatenate(a), np.concatenate(b)
        end_a, end_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)      # a text's end is one
        of_a, of_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        of_text = np.searchsorted(end_a[np.cumsum(n_a) - 1], cuts)      # of each group
        group, left, right, each = _links(a, b, of_a, of_b, len(cuts))
        kinds_a, kinds_b = len(self.a.bytes_of), len(self.b.bytes_of)
        held, place = np.unique((of_text[group] * kinds_a + left) * kinds_b + right, return_inverse=True)
        times, n_links = np.zeros(len(held), np.int64), np.zeros(len(n_a), np.int64)
        np.add.at(times, place, each)
        text, pair = np.divmod(held, kinds_a * kinds_b)
        np.add.at(n_links, text, times)
        return [n_a, n_b, np.bincount(of_text, minlength=len(n_a)), n_links, text + first, pair, times,
                self._digests(a, b, of_a, of_b, len(cuts), np.cumsum(n_a + n_b))]

    def _digests(self, a, b, of_a, of_b, groups: int, ends: np.ndarray) -> list[str]:
        """sha256 of each text's groups as written; ``ends`` are the texts' ends in tokens of both sides."""
        n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        end = np.zeros(len(a) + len(b), np.int64)
        ids = np.empty(len(end), np.int64)
        at_a = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[of_a]
        at_b = np.arange(len(b)) + np.cumsum(n_a)[of_b]
        ids[at_a], ids[at_b] = a, b
        end[at_a[np.cumsum(n_a) - 1]] = 1
        end[at_b[np.cumsum(n_b) - 1]] = 2
        end[ends - 1] = 3
        written = self.written[end * self.some + ids].tolist()
        return [hashlib.sha256("".join(written[i:j]).encode()).hexdigest()
                for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _batches(row: dict | None) -> Iterator[pa.RecordBatch]:
    if row is None:
        return
    a, b, copies = row["pairs"]
    pairs = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(copies, pa.int64())], ["a", "b", "copies"])
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    numbers = [one(pa.array(row[c], pa.int64())) for c in ("n_a", "n_b", "n_groups", "n_links")]
    columns = [pa.array([row["chunk"]]), one(pa.array(row["sha"], pa.binary())), *numbers, one(pa.array(row["groups_sha256"], pa.string())),
               one(pairs), one(pa.array(row["ends"], pa.int64())), pa.array([row["places"]], pa.binary()), pa.array([row["times"]], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CHUNK.split(", ")])


def _chunks(texts: DataFrame, path_a: str | None, path_b: str | None) -> DataFrame:
    """``CHUNK`` rows of ``sha, text, copies`` rows, whose texts are distinct and not empty."""
    (name_a, spec_a), (name_b, spec_b) = _spec(texts, path_a or default_a()), _spec(texts, path_b or default_b())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held, size = Aligner(*_both((name_a, name_b), spec_a, spec_b)), [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if held and (len(held) >= CHUNK_TEXTS or size + len(row[1]) > CHUNK_BYTES):
                    yield from _batches(aligner.chunk(*map(list, zip(*held, strict=True))))
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield from _batches(aligner.chunk(*map(list, zip(*held, strict=True))))
    return texts.mapInArrow(run, CHUNK)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``a, b, n``: how many documents hold the pair linked."""
    return chunks.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("copies").alias("n"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            places, times = unpack(row["places"]), unpack(row["times"])
            n, best = np.zeros(len(row["counted"]), np.int64), np.zeros(len(row["counted"]), bool)
            for x in row["counted"]:
                n[x["place"]], best[x["place"]] = x["n"], x["best"]
            upto = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[[0, *row["ends"]]])  # noqa: B023, E731
            columns = [pa.array(row["sha"], pa.binary()), *(pa.array(row[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                       pa.array(upto(times * best[places])), pa.array(upto(times * n[places])), pa.array(row["groups_sha256"], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MEASURES.split(", ")])


def align(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The distinct texts' measures (``MEASURES``, by the text's sha256) and the corpus's pairs ``a, b, n, best``:
    the documents that hold a pair, and whether no pair of that A id is held by more."""
    distinct = docs.select(F.col(f"`{text}`").cast("string").alias("text")).filter("text <> ''") \
        .groupBy("text").agg(F.count("*").alias("copies"))
    chunks = shared(_chunks(distinct.select(_sha("text").alias("sha"), "text", "copies"), path_a, path_b), "aligned")
    counts = shared(pair_counts(chunks), "pairs")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    pairs = counts.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))
    entries = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair")).select("chunk", "place", "pair.a", "pair.b")
    counted = entries.join(pairs.hint("rebalance"), ["a", "b"]).groupBy("chunk") \
        .agg(F.collect_list(F.struct("place", "n", "best")).alias("counted"))      # a chunk's size bounds it
    measures = chunks.drop("pairs").join(counted, "chunk").mapInArrow(_measure, MEASURES)
    return measures, pairs


def _sha(text):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def alignment_digests(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Contract columns of ``op13``."""
    measures, _ = align(docs, path_a=path_a, path_b=path_b)
    rows = docs.select("doc_id", whole("text").alias("text")).select("doc_id", _sha("text").alias("sha"))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return rows.join(measures, "sha", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
