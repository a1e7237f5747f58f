"""Token counts of a unigram tokenizer without its tokens (operator 2).

An Aho-Corasick automaton lists every vocabulary piece in a word; dynamic programming over
the places carries the best score and the number of pieces that reach it, and nothing to trace back.
Ties follow the tokenizer: a place keeps the first candidate of the best score, candidates
coming by start, so the longest piece that ends there wins. A character that is no piece
is an unknown of the lowest score less 10; unknowns side by side are one string, which is
counted by its UTF-8 bytes if the vocabulary has byte pieces, else once.

Texts are normalised as the vocabulary's (a leading mark, marks for spaces). When no piece has a mark after
another character, a best path never crosses from a word to the next mark, and words are counted one by
one and remembered; else a text is one word.

Defined results: null and empty texts have no tokens and score 0; every row gives one row; whole texts are
counted. Columns other than the named ones are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import arrow_map, whole

MARK = "▁"
UNKNOWN = 10.0             # below the lowest score
MAX_PIECES = 1 << 20       # of a vocabulary that is sent to the tasks
CACHED_WORDS = 300_000
CACHED_LENGTH = 40


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, float], ...]      # with their scores
    unknown: str
    byte_pieces: bool


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str | None = None) -> Vocabulary:
    """Pieces and scores of a sentencepiece file, taken as a unigram vocabulary."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path or default_path())
    if (n := sp.get_piece_size()) > MAX_PIECES:
        raise ValueError(f"{n} pieces, at most {MAX_PIECES} are sent to the tasks")
    pieces = tuple((sp.id_to_piece(i), sp.get_score(i)) for i in range(n))
    return Vocabulary(pieces, sp.id_to_piece(sp.unk_id()), any(map(sp.is_byte, range(n))))


class Counter(dict):
    """(score, tokens) of words; bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.characters = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.lowest = min(s for _, s in vocabulary.pieces) - UNKNOWN
        self.byte_pieces = vocabulary.byte_pieces
        marks_first = all(MARK not in p.lstrip(MARK) for p, _ in vocabulary.pieces)
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall if marks_first else lambda text: [text]

    def count(self, word: str) -> tuple[float, int]:
        """Best score and number of tokens by dynamic programming over the places of ``word``."""
        if self.characters.issuperset(word):
            score, tokens = [0.0] + [None] * len(word), [0] * (len(word) + 1)
            for last, (length, own) in self.automaton.iter(word):     # by end, the longest first
                start = last + 1 - length
                now = score[start] + own
                if score[last + 1] is None or now > score[last + 1]:
                    score[last + 1], tokens[last + 1] = now, tokens[start] + 1
            return score[-1], tokens[-1]
        return self._with_unknowns(word)

    def _with_unknowns(self, word: str) -> tuple[float, int]:
        pieces: list[list] = [[] for _ in word]
        for last, (length, own) in self.automaton.iter(word):
            pieces[last].append((last + 1 - length, own))
        score, tokens, after_unknown = [0.0], [0], [False]
        for last, char in enumerate(word):
            best = None
            for start, own in pieces[last]:
                now = score[start] + own
                if best is None or now > best:
                    best, n, unknown = now, tokens[start] + 1, False
            if char not in self.characters and (best is None or score[last] + self.lowest > best):
                best, unknown = score[last] + self.lowest, True
                n = tokens[last] + (len(char.encode()) if self.byte_pieces else not after_unknown[last])
            score.append(best)
            tokens.append(n)
            after_unknown.append(unknown)
        return score[-1], tokens[-1]

    def __missing__(self, word: str) -> tuple[float, int]:
        found = self.count(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found

    def text(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        found = list(map(self.__getitem__, self.words(MARK + text.replace(" ", MARK))))
        return float(sum(s for s, _ in found)), sum(n for _, n in found)


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key, n_tokens, score`` of each whole text."""
    vocabulary = read_vocabulary(path)
    name = hashlib.sha256(repr(vocabulary).encode()).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if name not in _counters:
            _counters.clear()
            _counters[name] = Counter(sent.value)
        found = [_counters[name].text(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in found], pa.int64()),
                                           pa.array([s for s, _ in found], pa.float64())], ["key", "n_tokens", "score"])
    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, whole(text)), run, f"key {kind}, n_tokens long, score double").withColumnRenamed("key", key)
