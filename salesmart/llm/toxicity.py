"""Toxic passages: maximum-scoring segments over token log-odds (operator 4).

Learning reads the labelled rows that ``labels`` gives (a sample of at most ``SAMPLE`` of them, by
hash). A feature is a word or a word's first four or five letters, so that inflected forms
share evidence. Its score is its log-odds between toxic and other texts under a Dirichlet prior
whose shape is the feature's frequency in the whole corpus; features below ``MIN_Z`` standard deviations don't
count, and every other token costs ``COST``. The scan of Ruzzo and Tompa finds all maximal
segments of a text in time linear in its tokens. Scores follow an extreme-value law: with
lambda the root of E[exp(lambda s)] = 1 over tokens of texts that aren't toxic, a segment of score S in a
text of N tokens has -ln E = lambda S - ln(K N). A text's evidence is the sum over its significant
segments (E < 1), and a logistic curve fitted on the sample turns it into the score.

Defined results: null and empty texts have no segments and get the curve's value at no evidence;
labels that are null are left out, a doc_id labelled twice has one label, toxic if any says so; every row of a labelled
doc_id is learned from, repeated rows as often as they occur; extra columns may have any names; without both
classes every score is 0; every row gives one row; whole texts are scanned. doc_id only chooses the rows to
learn from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import arrow_map, whole

SAMPLE = 40_000           # labelled rows that are learned from, at most
MAX_FEATURES = 50_000     # of a model
MIN_TEXTS = 3             # of the sample's toxic texts that a feature is in
MIN_Z = 4.0
PRIOR = 100_000.0         # pseudo-tokens
CLIP = 6.0
COST = 0.5
K = 0.1
CACHED_WORDS = 200_000
STEMS = (4, 5)
HELD_OUT = 5
_words = re.compile(r"\w+").findall


def features(word: str) -> set[str]:
    return {word, *(word[:k] + "-" for k in STEMS if len(word) > k)}


class Scores(dict):
    """Score of a word, 0 where no feature counts; bounded."""

    def __init__(self, model: dict[str, float]):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        score = max((self.model.get(f, 0.0) for f in features(word)), default=0.0)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = score
        return score


@dataclass
class Model:
    """What ``fit`` learns; its size is bounded by MAX_FEATURES."""
    scores: dict[str, float]
    rate: float = 1.0           # lambda
    intercept: float = -50.0
    slope: float = 0.0


def segments(scores: np.ndarray, cost: float = COST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``start, end, score`` of tokens that score ``scores`` or, where that is 0, minus
    ``cost``. Each kept segment points at the last one before it whose left sum is lower, so the search back
    is linear over all."""
    kept: list[list] = []      # start, end, sum left of it, sum at its end, pointer
    gained = 0.0
    for k, at in enumerate(np.flatnonzero(scores).tolist()):
        left = gained - cost * (at - k)
        gained += float(scores[at])
        start, end, right = at, at + 1, gained - cost * (at - k)
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append([start, end, left, right, j])
                break
            start, left, after = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = after
    return [(s, e, r - lo) for s, e, lo, r, _ in kept]


def evidence(text: str, table: Scores, rate: float) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Summed -ln E of the significant segments, and those: first and last token, score, E."""
    words = _words(text.lower())
    scores = np.fromiter(map(table.__getitem__, words), np.float64, len(words))
    found, total = [], 0.0
    for start, end, score in segments(scores):
        bits = rate * score - math.log(K * len(words))
        if bits > 0:
            found.append((start, end, score, math.exp(-bits)))
            total += bits
    return total, found


_tables: dict[int, Scores] = {}


def _table(model) -> Scores:
    """One word table a Python worker and model."""
    if model.id not in _tables:
        _tables.clear()
        _tables[model.id] = Scores(model.value.scores)
    return _tables[model.id]


class _Sent:
    """A broadcast with an identity that the workers can keep tables by."""

    def __init__(self, spark, value):
        self.sent = spark.sparkContext.broadcast(value)
        self.id = f"{spark.sparkContext.applicationId}-{id(self.sent)}-{np.random.default_rng().integers(1 << 62)}"

    @property
    def value(self):
        return self.sent.value


def _counts(rows: DataFrame) -> DataFrame:
    """``feature, toxic, other, texts``: token counts over ``label int, text`` rows; toxic texts that have the feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts):
            names = list(set(counts[0]) | set(counts[1]))
            other, toxic, texts = (pa.array([c[n] for n in names], pa.int64()) for c in counts)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), toxic, other, texts],
                                              ["feature", "toxic", "other", "texts"])
        counts = (Counter(), Counter(), Counter())
        for batch in batches:
            words = (Counter(), Counter())
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _words(text.lower())
                words[label].update(found)
                counts[label][""] += len(found)        # of all tokens
                if label:
                    counts[2].update({f for w in set(found) for f in features(w)})
            for label in (0, 1):
                for word, n in words[label].items():
                    for f in features(word):
                        counts[label][f] += n
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield out(counts)
                counts = (Counter(), Counter(), Counter())
        yield out(counts)
    part = rows.mapInArrow(run, "feature string, toxic long, other long, texts long")
    return part.groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("toxic", "other", "texts")))


def _corpus(texts: DataFrame, names: list[str]) -> dict[str, int]:
    """How often each of ``names`` occurs in all texts; at '' the number of tokens."""
    sent = _Sent(texts.sparkSession, set(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts, cache = sent.value, Counter(), {}
        for batch in batches:
            words = Counter()
            for text in batch.column(0).to_pylist():
                words.update(_words(text.lower()))
            for word, n in words.items():
                own = cache.get(word)
                if own is None:
                    if len(cache) > CACHED_WORDS:
                        cache.clear()
                    own = cache[word] = tuple(features(word) & wanted)
                for f in own:
                    counts[f] += n
            counts[""] += words.total()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         ["feature", "n"])
    rows = texts.mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n")).collect()
    return {f: n for f, n in rows}


def log_odds(toxic, other, corpus, n_toxic, n_other, n_corpus, prior: float = PRIOR):
    """Log-odds under a Dirichlet prior shaped by the corpus, and their z-scores."""
    a = prior * np.maximum(corpus, 1) / max(n_corpus, 1)
    odds = lambda y, n: np.log((y + a) / np.maximum(n + prior - y - a, 1e-9))
    delta = odds(toxic, n_toxic) - odds(other, n_other)
    return delta, delta / np.sqrt(1 / (toxic + a) + 1 / (other + a))


def root(scores: np.ndarray, chances: np.ndarray, cost: float = COST) -> float:
    """lambda: the positive root of E[exp(lambda s)] = 1, the rest of the chance being at -cost."""
    rest = max(1e-9, 1 - float(chances.sum()))
    gain = lambda x: float((chances * np.exp(np.minimum(x * scores, 700))).sum()) + rest * math.exp(-x * cost) - 1
    low, high = 1e-6, 1e-6
    while gain(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if gain(mid) < 0 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope by Newton steps over points of some weight."""
    w, design = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge * np.eye(2), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Learn from the ``labels`` rows (key, label) given; corpus frequencies come from all ``docs``."""
    own = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")) \
        .filter("id is not null and label is not null")
    own = own.groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
    own = own.orderBy(F.xxhash64("id"), "id").limit(sample)
    # at most ``sample`` rows of 12 bytes; the documents' other columns may have any names, these two included
    rows = docs.select(F.col(f"`{key}`").alias("id"), whole(F.col(f"`{text}`")).alias("text")) \
        .join(F.broadcast(own), "id").select("label", "text")
    counts = _counts(rows)
    totals = counts.filter("feature = ''").first()
    if not totals or not totals["toxic"] or not totals["other"]:
        return Model({})
    n_toxic, n_other = totals["toxic"], totals["other"]
    found = counts.filter((F.col("feature") != "") & (F.col("texts") >= MIN_TEXTS) &
                          (F.col("toxic") * n_other > 2 * F.col("other") * n_toxic)) \
        .orderBy(F.desc("toxic"), "feature").limit(MAX_FEATURES).collect()
    names = [r["feature"] for r in found]
    corpus = _corpus(docs.select(whole(F.col(f"`{text}`")).alias("text")), names)
    of = lambda c: np.array([r[c] for r in found], np.float64)
    n = np.array([corpus.get(f, 0) for f in names], np.float64)
    delta, z = log_odds(of("toxic"), of("other"), n, n_toxic, n_other, corpus.get("", 0))
    use = np.flatnonzero((z >= MIN_Z) & (delta > COST))
    if not len(use):
        return Model({})
    scores = np.minimum(delta, CLIP)[use]
    prior = PRIOR * n[use] / max(corpus[""], 1)
    rate = root(scores, np.minimum((of("other")[use] + np.minimum(prior, 1)) / n_other, 0.5 / len(use)))
    model = Model({names[k]: float(s) for k, s in zip(use, scores, strict=True)}, rate)
    # the curve is fitted on evidence to three digits: however many rows share an id, some 28,000 values at most reach the driver
    seen = _evidence(rows.select(F.col("label").alias("key"), "text"), model, False) \
        .groupBy(F.col("key").alias("label"), F.round(F.log1p("evidence"), 3).alias("x")).agg(F.count("*").alias("n")).collect()
    y, x, weight = (np.array([r[c] for r in seen], np.float64) for c in ("label", "x", "n"))
    model.intercept, model.slope = logistic(x, y, weight)
    return model


def _evidence(rows: DataFrame, model: Model, with_segments: bool) -> DataFrame:
    sent, rate = _Sent(rows.sparkSession, model), model.rate
    kind = rows.schema["key"].dataType.simpleString()
    span = "array<struct<start:int,end:int,score:double,e_value:double>>"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = _table(sent)
        found = [evidence(t, table, rate) for t in batch.column(1).to_pylist()]
        out = [batch.column(0), pa.array([x[0] for x in found], pa.float64())]
        names = ["key", "evidence"]
        if with_segments:
            names.append("segments")
            fields = [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]
            out.append(pa.array([[dict(zip(("start", "end", "score", "e_value"), s, strict=True)) for s in x[1]] for x in found],
                                pa.list_(pa.struct(fields))))
        return pa.RecordBatch.from_arrays(out, names)
    return arrow_map(rows, run, f"key {kind}, evidence double" + f", segments {span}" * with_segments)


def toxic_passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, evidence, segments`` (token places) of each whole text."""
    found = _evidence(docs.select(F.col(f"`{key}`").alias("key"), whole(F.col(f"`{text}`")).alias("text")), model, True)
    score = 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * F.log1p("evidence")))) if model.scores else F.lit(0.0)
    return found.select(F.col("key").alias(key), score.alias("score"), "evidence", "segments")


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of ``op4``."""
    model = fit(docs, labels.filter(~held_out()))
    found = toxic_passages(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                        F.size("segments").alias("passages"))
