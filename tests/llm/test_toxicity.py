import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import toxicity as tox
from salesmart.llm.common import table

from .cases import ODD, docs


def slow_segments(scores, cost):
    """Ruzzo and Tompa's definition: the best segment, then the same left and right of it."""
    s = [x if x else -cost for x in scores]

    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += s[j]
                if total > 1e-12 and (top is None or total > top[0] + 1e-12):
                    top = (total, i, j + 1)
        return [] if top is None else best(lo, top[1]) + [(top[1], top[2], top[0])] + best(top[2], hi)
    return best(0, len(s))


@pytest.mark.parametrize("seed", range(60))
def test_segments_by_brute_force(seed):
    rng = random.Random(seed)
    scores = np.array([rng.choice([0, 0, 0, rng.uniform(0.6, 3)]) for _ in range(40)])     # no ties
    cost = rng.choice([0.5, 0.8, 1.1])
    got, want = tox.segments(scores, cost), slow_segments(scores.tolist(), cost)
    assert sum(g[2] for g in got) == pytest.approx(sum(w[2] for w in want))
    assert max((g[2] for g in got), default=0) == pytest.approx(max((w[2] for w in want), default=0))
    assert len(got) == len(want)


def test_log_odds_shrink_to_the_prior():
    delta, z = tox.log_odds(np.array([50.0, 1.0, 0.0]), np.array([0.0, 0.0, 0.0]), np.array([100.0, 1.0, 1.0]), 10_000, 90_000, 1_000_000)
    assert delta[0] > tox.COST and z[0] > tox.MIN_Z > abs(z[2])


def test_lambda():
    rate = tox.root(np.array([5.0]), np.array([0.001]))
    assert 0.001 * np.exp(5 * rate) + 0.999 * np.exp(-0.5 * rate) == pytest.approx(1, abs=1e-6)


def test_held_out_accuracy(spark):
    documents, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = {r.doc_id: r for r in tox.toxicity(documents, labels).collect()}
    rows = [(got[r.doc_id], r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(got) == documents.count() and len(rows) > 500
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
               for r in got.values())
    assert np.mean([r.predicted == t for r, t in rows]) >= 0.97
    assert np.mean([r.predicted for r, t in rows if t]) >= 0.85 and np.mean([r.predicted for r, t in rows if not t]) <= 0.01


def test_held_out_labels_change_nothing(spark):
    documents, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    scores = [{r.doc_id: r.score for r in tox.toxicity(documents, x).collect()} for x in (labels, other)]
    assert scores[0] == scores[1]


def rows(spark):
    texts = [f"good words number{k} here and there" + " awfulword awfuller" * (k % 4 == 0) for k in range(400)]
    return texts, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")


def test_passages_and_odd_rows(spark):
    texts, labels = rows(spark)
    texts += ODD
    model = tox.fit(docs(spark, texts), labels)
    got = {r.doc_id: r for r in tox.toxic_passages(docs(spark, texts), model).collect()}
    assert len(got) == len(texts) and got[0].score > 0.5 > got[1].score
    assert [(s.start, s.end) for s in got[0].segments] == [(6, 8)]
    assert got[400].score == got[401].score < 0.5 and got[400].segments == []


def test_labels_that_say_nothing(spark):
    texts, labels = rows(spark)
    for some in (labels.filter("toxic = 0"), labels.filter("doc_id < 0"), labels.selectExpr("doc_id", "cast(null as int) AS toxic")):
        assert {r.score for r in tox.toxicity(docs(spark, texts[:20]), some).collect()} == {0.0}
    twice = labels.unionByName(labels.filter("toxic = 0")).unionByName(spark.createDataFrame([(None, 1)], labels.schema))
    assert tox.toxicity(docs(spark, texts, [None, *range(1, 400)]), twice).count() == 400
    assert tox.toxicity(docs(spark, []), labels).count() == 0


def test_repeats_of_a_labelled_row(spark):
    """The curve is fitted on weights, so any number of repeats brings few values to the driver, and they count."""
    texts, labels = rows(spark)
    once = docs(spark, texts + ODD)
    again = once.filter("doc_id = 0").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(2_000)))).drop("again").unionByName(once)
    model, plain = tox.fit(again, labels), tox.fit(once, labels)
    assert model.intercept != plain.intercept and tox.toxic_passages(once, model).filter("doc_id = 0").first().score > 0.9


def test_weighted_curve():
    x, y, n = np.array([0.0, 1.0, 2.0, 0.5]), np.array([0.0, 1.0, 1.0, 0.0]), np.array([3.0, 2.0, 1.0, 4.0])
    assert tox.logistic(x, y, n) == pytest.approx(tox.logistic(np.repeat(x, n.astype(int)), np.repeat(y, n.astype(int)), np.ones(10)))
