from collections import Counter

import numpy as np
import pytest
import xxhash

from salesmart.llm import quality
from salesmart.llm.common import table

from .cases import ODD, docs


def test_accuracies_of_made_votes():
    """Labellers of known accuracies: the estimates come near, and the posteriors tell the classes apart."""
    rng = np.random.default_rng(2)
    n, k = 40_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    right = np.linspace(0.7, 0.95, k)
    votes = np.where(rng.random((n, k)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[rng.random((n, k)) < 0.2] = 2
    patterns, counts = np.unique((votes * 3 ** np.arange(k)).sum(1), return_counts=True)
    found = quality.Accuracies(patterns, counts)
    given = found.chance / found.chance[:, :, :2].sum(2, keepdims=True)
    assert np.abs(given[1, :, 1] - right).max() < 0.05 and abs(found.share[1] - 0.8) < 0.05
    which = {p: i for i, p in enumerate(patterns)}
    posterior = found.posterior(patterns)[[which[p] for p in (votes * 3 ** np.arange(k)).sum(1)]]
    assert ((posterior >= 0.5) == good).mean() > 0.93


@pytest.mark.parametrize("right", [[0.9] * 6 + [0.5, 0.3], [0.9, 0.9, 0.9, 0.8, 0.7, 0.5, 0.5, 0.3]])
def test_useless_and_inverted_labellers(right):
    """Both classes' estimates come near, of labellers that toss a coin or are mostly wrong too, at any size of the data."""
    rng, right = np.random.default_rng(7), np.array(right)
    n, k = 200_000, len(right)
    good = rng.random(n) < 0.8
    votes = np.where(rng.random((n, k)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[rng.random((n, k)) < 0.3] = 2
    patterns, counts = np.unique((votes * 3 ** np.arange(k)).sum(1), return_counts=True)
    for times in (1, 1000):
        found = quality.Accuracies(patterns, counts * times)
        given = found.chance / found.chance[:, :, :2].sum(2, keepdims=True)
        assert np.abs(given[0, :, 0] - right).max() < 0.05 and np.abs(given[1, :, 1] - right).max() < 0.05


def test_query_against_slow_version(spark):
    """Every step in plain Python: votes of all rows, the classes' chances, the distinct texts in order of their hash, the scorer."""
    documents = table(spark, "/root/testdata/sf0.001", "documents")
    texts = [(r.doc_id, r.text or "") for r in documents.collect()]
    words = quality.Words()
    votes = Counter(words.read(t).votes() for _, t in texts)
    accuracies = quality.Accuracies(np.array(sorted(votes)), np.array([votes[p] for p in sorted(votes)]))
    order = sorted({t for _, t in texts}, key=lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63, t))
    at, which, share = [], [], []
    for k, t in enumerate(order):
        read = words.read(t)
        f, n = np.unique(read.features(), return_counts=True)
        at, which, share = at + [k] * len(f), which + f.tolist(), share + (n / max(read.n, 1)).astype(np.float32).tolist()
    good = accuracies.posterior(np.array([words.read(t).votes() for t in order]))
    model = quality.Model(accuracies, *quality.train(good, np.array(at), np.array(which), np.array(share)))
    want = {i: model.score(words.read(t)) for i, t in texts}
    got = {r.doc_id: r.score for r in quality.quality(documents).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in got)


def test_repeated_rows_are_learned_once(spark):
    """A third of all rows is one row: the scorer learns from each text once, and runs agree."""
    texts = [f"The fox number {k} is in the garden and it was for you." if k % 5 else f"*** {k} ||| ### $$$ %%% ~~~" for k in range(200)]
    plain = docs(spark, texts)
    again = plain.unionByName(docs(spark, texts[:1] * 100, [0] * 100)).repartition(5)
    runs = [{r.doc_id: r.score for r in quality.quality(again).collect()} for _ in range(2)]
    assert runs[0] == runs[1] and all((runs[0][k] >= 0.5) == bool(k % 5) for k in range(1, 200))
    few = quality.fit(again, sample=50)
    assert (np.array([few.score(quality.Words().read(t)) >= 0.5 for t in texts]) == np.array([bool(k % 5) for k in range(200)])).mean() > 0.95


def test_votes_round_trip():
    stats = {name: 0.0 for name, *_ in quality.LABELLERS}
    assert quality.digits(np.array([quality.votes(stats, 100)]))[0].tolist() == [1, 1, 1, 1, 1, 0, 0, 0]
    assert quality.digits(np.array([quality.votes({}, 0)]))[0].tolist() == [2] * len(quality.LABELLERS)


@pytest.mark.parametrize("word, want", [("Thre***", "Aa***"), ("THE!!", "A!!"), ("a1b22", "a0a0"), ("|", "|"), ("élan", "a")])
def test_shape(word, want):
    assert quality.shape(word) == want


def test_against_labels(spark):
    documents, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality(documents).collect()}
    rows = [(got[r.doc_id].accepted, r.quality) for r in labels.collect()]
    assert len(got) == documents.count()
    assert np.mean([a for a, q in rows if q]) >= 0.99 and np.mean([a for a, q in rows if not q]) <= 0.05


def test_keep_good_is_the_query(spark):
    documents = table(spark, "/root/testdata/sf0.001", "documents")
    accepted = {r.doc_id for r in quality.quality(documents).collect() if r.accepted}
    kept = quality.keep_good(documents)
    assert {r.doc_id for r in kept.collect()} == accepted and kept.columns == documents.columns


def test_odd_rows(spark):
    rows = docs(spark, ODD + ["The quick fox is in the garden and it was for you."] * 20)
    assert quality.quality(rows).count() == len(ODD) + 20
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns and kept.schema["a.b"].dataType == rows.schema["a.b"].dataType and kept.count() > 0
    assert quality.quality(docs(spark, ["a", "a"], [None, None])).count() == 2
    assert quality.quality(docs(spark, [])).count() == 0 and quality.keep_good(docs(spark, [])).count() == 0


def test_words_start_anew(monkeypatch):
    table_ = quality.Words()
    first = table_.read("One two 3 four, two two")
    want = first.statistics(), first.features().tolist()
    monkeypatch.setattr(quality, "CACHED_WORDS", 2)
    table_.read("five six seven")
    again = table_.read("One two 3 four, two two")
    assert want == (again.statistics(), again.features().tolist())
