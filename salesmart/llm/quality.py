"""Quality classifier from weak labels (operator 9).

Overlapping heuristic labellers vote good, bad or nothing on each text. Only the counts of vote patterns
(3 to the power of the labellers, whatever the input) reach the driver, over all texts; there
expectation-maximisation estimates each labeller's accuracy in either class. The posteriors of a
bounded sample of texts (``SAMPLE``, by hash) train a logistic scorer over hashed token shapes
and pairs of them, which then scores every text. No label is read.

Defined results: null and empty texts get no votes, and the scorer's value for a text without
features; every row gives one row; texts are read whole; doc_id only chooses the sample.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import arrow_map, whole

SAMPLE = 10_000            # distinct texts that train the scorer, about; never more than twice as many, then those of least hash
DIMENSIONS = 1 << 14
CACHED_WORDS = 150_000
TRUST = 20.0               # prior: so many right votes of each labeller in each class, whatever the data's size
ROUNDS = 100               # of expectation-maximisation, at most
STEPS = 400                # of the scorer's training
LEAST_WORDS = 5            # shorter texts get votes on symbols only
#: Frequent function words of the languages looked for.
FUNCTION_WORDS = frozenset((
    "the of and to in a is that it was for on with as at by this from or an be are "
    "der die das und zu von ist mit den im nicht ein eine auf für sich dem auch als "
    "de la le et les des en un une est que dans qui sur pas pour au plus par "
    "el los las que y del se con una por para no su es lo").split())
#: Labellers: (statistic, bad at or above, good at or below); for the last three low is bad.
LABELLERS = (
    ("marked", 0.15, 0.03), ("lone", 0.10, 0.02), ("capitals", 0.40, 0.15), ("shouts", 0.20, 0.05), ("repeats", 0.15, 0.03),
    ("types", 0.30, 0.45), ("plain", 0.88, 0.92), ("function", 0.005, 0.05))
LOW_IS_BAD = 5             # from this labeller on
STATISTICS = ("marked", "lone", "capitals", "shouts", "function", "n_alphanumeric", "n_characters")
_MARK, _SIGN = re.compile(r"[^\w\s.,;:!?'\"()\-]"), re.compile(r"[^\w\s]+")
_UPPER, _LOWER, _OTHER = re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"\d+")


def shape(word: str) -> str:
    """Runs of capitals, other letters and digits as one character each; signs stay."""
    return _UPPER.sub("A", _LOWER.sub("a", _OTHER.sub("0", word)))


def hashed(name: str) -> int:
    return xxhash.xxh64_intdigest(name) % DIMENSIONS


class Words(dict):
    """Numbers of words, and each number's profile: what the statistics and shapes need to know of a word. Few
    words differ in profile. Bounded between texts."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.of_word, self.profiles = array("i"), {}
        self.rows = np.zeros((1024, len(STATISTICS)), np.float32)
        self.shapes = np.zeros(1024, np.int64)

    def __missing__(self, word: str) -> int:
        body, end, n = word[:-1], word[-1], len(word)
        if word.isalpha() and word.islower():
            profile = (False, False, False, False, word in FUNCTION_WORDS, n, n, "a")
        elif end in ".," and body.isalpha() and body.islower():
            profile = (False, False, False, False, body in FUNCTION_WORDS, n - 1, n, "a" + end)
        else:
            profile = self._profile(word)
        which = self.profiles.get(profile)
        if which is None:
            which = self.profiles[profile] = len(self.profiles)
            if which == len(self.rows):
                self.rows, self.shapes = np.concatenate([self.rows, self.rows]), np.concatenate([self.shapes, self.shapes])
            self.rows[which], self.shapes[which] = profile[:-1], hashed(profile[-1])
        self.of_word.append(which)
        at = self[word] = len(self)
        return at

    @staticmethod
    def _profile(word: str) -> tuple:
        letters, upper = sum(map(str.isalpha, word)), sum(map(str.isupper, word))
        lone = _SIGN.fullmatch(word) is not None
        return (not lone and _MARK.search(word) is not None, lone, letters > 1 and upper == letters, "!!" in word,
                word.lower().strip(".,;:!?") in FUNCTION_WORDS, sum(map(str.isalnum, word)), len(word), shape(word))

    def read(self, text: str) -> "Text":
        if len(self) > CACHED_WORDS:
            self.clear()
        words = text.split()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        which = np.frombuffer(self.of_word, np.int32)[at] if words else at
        same = at[1:] == at[:-1]
        return Text(self, words, which, same)


class Text:
    """One text's words as their profiles."""

    def __init__(self, table: Words, words: list[str], which: np.ndarray, same: np.ndarray):
        self.table, self.words, self.n, self.which, self.same = table, words, len(words), which, same

    def statistics(self) -> dict[str, float]:
        if not self.n:
            return {}
        total = dict(zip(STATISTICS, self.table.rows[self.which].sum(0, dtype=np.float64), strict=True))
        stats = {k: total[k] / self.n for k in ("marked", "lone", "capitals", "shouts", "function")}
        return stats | {"repeats": self.same.sum() / self.n, "plain": total["n_alphanumeric"] / total["n_characters"],
                        "types": len(set(self.words)) / min(self.n, 200 + 0.2 * self.n)}      # long texts have fewer types to a word

    def features(self) -> np.ndarray:
        """Hashed token shapes, then hashed pairs of neighbours."""
        shapes = self.table.shapes[self.which]
        shapes[1:][self.same] = REPEATED
        return np.concatenate([shapes, (shapes[1:] * 31 + shapes[:-1] * 17 + 7) % DIMENSIONS])

    def votes(self) -> int:
        return votes(self.statistics(), self.n)


REPEATED = hashed("=")


def votes(stats: dict[str, float], n: int) -> int:
    """The votes as digits to the base 3, the first labeller's last: 0 bad, 1 good, 2 none."""
    pattern = 0
    for k, (name, bad, good) in reversed(list(enumerate(LABELLERS))):
        x = stats.get(name)
        if x is None or n < LEAST_WORDS and name not in ("marked", "lone"):
            vote = 2
        elif k < LOW_IS_BAD:
            vote = 0 if x >= bad else 1 if x <= good else 2
        else:
            vote = 0 if x <= bad else 1 if x >= good else 2
        pattern = pattern * 3 + vote
    return pattern


def digits(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


class Accuracies:
    """Chances of each labeller's votes in the classes bad and good, and the classes' shares."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray):
        v = digits(patterns)
        hot = np.stack([v == k for k in range(3)], 2).astype(np.float64)       # pattern, labeller, vote
        good = np.where((v == 0).any(1), 0.1, 0.9)
        prior = np.full((2, len(LABELLERS), 3), 0.5)        # labellers are better than chance
        prior[[0, 1], :, [0, 1]] += TRUST
        for _ in range(ROUNDS):
            w = np.stack([1 - good, good], 1) * counts[:, None]
            self.share = (w.sum(0) + 1) / (w.sum() + 2)
            self.chance = (np.einsum("pc,plv->clv", w, hot) + prior) / (w.sum(0)[:, None] + prior.sum(2))[:, :, None]
            was, good = good, self.posterior(patterns)
            if np.abs(good - was).max() < 1e-6:
                break

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance that a text with these votes is good. A labeller without a vote says nothing."""
        v = digits(patterns)
        given = np.log(self.chance / self.chance[:, :, :2].sum(2, keepdims=True))
        each = given[:, np.arange(len(LABELLERS)), np.minimum(v, 1)] * (v < 2)
        odds = each[1].sum(1) - each[0].sum(1) + np.log(self.share[1] / self.share[0])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class Model:
    def __init__(self, accuracies: Accuracies, weights: np.ndarray, intercept: float):
        self.accuracies, self.weights, self.intercept = accuracies, weights, intercept

    def score(self, text: Text) -> float:
        x = self.intercept + (float(self.weights[text.features()].sum()) / text.n if text.n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


_words: list[Words] = []


def _table() -> Words:
    """One word table a Python worker."""
    if not _words:
        _words.append(Words())
    return _words[0]


def _patterns(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                p = _table().read(text).votes()
                counts[p] = counts.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                         ["pattern", "n"])
    return texts.mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def train(good: np.ndarray, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic scorer for soft labels, by Adagrad steps on the whole sample."""
    w, b, seen, seen_b = np.zeros(DIMENSIONS), 0.0, np.full(DIMENSIONS, 1e-8), 1e-8
    for _ in range(STEPS):
        x = np.bincount(rows, values * w[columns], len(good)) + b
        off = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - good
        grad, grad_b = np.bincount(columns, values * off[rows], DIMENSIONS) / len(good) + 1e-5 * w, off.mean()
        seen, seen_b = seen + grad ** 2, seen_b + grad_b ** 2
        w, b = w - 0.5 * grad / np.sqrt(seen), b - 0.5 * grad_b / np.sqrt(seen_b)
    return w, b


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    texts = docs.select(whole(text).alias("text"))
    found = _patterns(texts).collect()          # at most 3 ** labellers rows
    patterns, counts = (np.array([r[k] for r in found], np.int64) for k in (0, 1))
    if not len(patterns):
        patterns, counts = np.array([3 ** len(LABELLERS) - 1]), np.array([0])
    accuracies = Accuracies(patterns, counts)
    share = min(1.0, sample / max(1, int(counts.sum())))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [])
        for t in batch.column(1).to_pylist():
            text = _table().read(t)
            which, times = np.unique(text.features(), return_counts=True)
            out[0].append(text.votes())
            out[1].append(which.astype("<i4").tobytes())
            out[2].append((times / max(text.n, 1)).astype("<f4").tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), *(pa.array(x, pa.binary()) for x in out[1:])],
                                          ["h", "pattern", "which", "share"])
    # by the text's hash, each text once: however often a text recurs, it is one text to the scorer
    few = texts.select(F.xxhash64("text").alias("h"), "text").filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates()
    rows = arrow_map(few, run, "h long, pattern long, which binary, share binary") \
        .orderBy("h", "which", "share").limit(2 * sample).drop("h").collect()
    if not rows:
        return Model(accuracies, np.zeros(DIMENSIONS), 0.0)
    which = [np.frombuffer(r[1], "<i4") for r in rows]
    good = accuracies.posterior(np.array([r[0] for r in rows], np.int64))
    weights, intercept = train(good, np.repeat(np.arange(len(rows)), [len(x) for x in which]), np.concatenate(which),
                               np.concatenate([np.frombuffer(r[2], "<f4") for r in rows]).astype(np.float64))
    return Model(accuracies, weights, intercept)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, posterior``: the scorer's chance that a text is good, and that of its votes alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, scores, patterns = sent.value, [], []
        for t in batch.column(1).to_pylist():
            text = _table().read(t)
            scores.append(own.score(text))
            patterns.append(text.votes())
        posterior = own.accuracies.posterior(np.array(patterns, np.int64)) if patterns else []
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(posterior, pa.float64())],
                                          ["key", "score", "posterior"])
    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, whole(text)), run, f"key {kind}, score double, posterior double").withColumnRenamed("key", key)


def quality(docs: DataFrame) -> DataFrame:
    """Columns of ``op9``: doc_id, score, accepted, posterior."""
    found = score(docs, fit(docs))
    return found.select("doc_id", "score", (F.col("score") >= 0.5).alias("accepted"), "posterior")


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the scorer accepts, all columns."""
    model = fit(docs, key, text)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for t in batch.column(at).to_pylist():
            keep.append(sent.value.score(_table().read(t or "")) >= 0.5)
        return batch.filter(pa.array(keep, pa.bool_()))
    names = [f"c{k}" for k in range(len(docs.columns))]
    return arrow_map(docs, run, docs.toDF(*names).schema).toDF(*docs.columns)
