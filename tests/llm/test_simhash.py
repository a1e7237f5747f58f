import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salesmart.llm import simhash
from salesmart.llm.components import components

from .cases import ODD, docs


def slow_fingerprint(text, k=3):
    words, cur = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, cur = words + [cur] if cur else words, ""
        else:
            cur += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, distance):
    at = list(range(len(prints)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                at[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [t for t in ODD if t is None or len(t) < 1000] + ["a b c d a b c d", "x  y\x0bz\x85w Ä B"])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") % (1 << 64) == slow_fingerprint(text)


def flipped(rng, n, spread):
    base = [rng.getrandbits(64) for _ in range(n)]
    out = list(base)
    for b in base:
        for _ in range(spread):
            out.append(out[-1] ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) if rng.random() < 0.5 else b ^ 1 << rng.randrange(64))
    return sorted(set(out))


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_components_of_fingerprints(spark, distance):
    prints = flipped(random.Random(distance), 60, 6)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance)).collect()
    root = {r.node: r.root for r in found}
    want, seen = brute(prints, distance), {}
    for i, w in enumerate(want):      # the same classes
        assert seen.setdefault(w, root.get(signed[i], signed[i])) == root.get(signed[i], signed[i])
    assert len(set(seen.values())) == len(seen)


def test_buckets_beyond_pairwise(spark, monkeypatch):
    ring = simhash.Ring(2)
    rng = np.random.default_rng(3)
    mask = np.uint64(ring.tables[4][1])
    fp = np.unique(rng.integers(0, 1 << 12, 3000).astype(np.uint64) << np.uint64(1) & ~mask)
    table, bucket = np.full(len(fp), 4), np.zeros(len(fp), np.int64)
    few = {(min(a, b), max(a, b)) for a, b in zip(*map(np.ndarray.tolist, simhash._links(ring, table, bucket, fp)), strict=True)}
    monkeypatch.setattr(simhash, "PAIRWISE", 4)
    many = {(min(a, b), max(a, b)) for a, b in zip(*map(np.ndarray.tolist, simhash._links(ring, table, bucket, fp)), strict=True)}
    assert few == many and few


def settled(spark, prints, distance):
    """The least fingerprint of each one's component."""
    root = {r.node: r.root for r in components(simhash.links(prints, distance)).collect()}
    return {r.fp: root.get(r.fp, r.fp) for r in prints.collect()}


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_bucket_dealt_anew(spark, monkeypatch, distance):
    prints = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in flipped(random.Random(distance), 60, 6)], "fp long")
    want = settled(spark, prints, distance)
    monkeypatch.setattr(simhash, "LARGE", -(1 << 40))
    assert settled(spark, prints, distance) == want
    ring = simhash.Ring(distance)
    assert simhash.deal(prints, ring).filter(F.col("t") < ring.coarse).count() == 0


def test_large_bucket_is_several(spark, monkeypatch):
    """A bucket of 40,000 fingerprints goes to the tasks in parts, with the same components."""
    ring = simhash.Ring(2)
    free = [b for b in range(64) if not ring.tables[3][1] >> b & 1]
    rng = np.random.default_rng(1)
    fps = np.unique(sum((rng.integers(0, 2, 40_000) << np.int64(b) for b in free[:25]), np.int64(0)))
    prints = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    largest = lambda: simhash.deal(prints, ring).groupBy("t", "bucket").count().agg(F.max("count")).first()[0]
    assert largest() == len(fps)
    want = settled(spark, prints, 2)
    monkeypatch.setattr(simhash, "LARGE", 5000)
    assert largest() < len(fps) / 50
    assert settled(spark, prints, 2) == want


def test_finer_tables_bound_a_bucket():
    """At distance 2 what the finer tables leave open is at most 18 bits, so a bucket of distinct fingerprints is at most 2^18."""
    ring = simhash.Ring(2)
    assert max(64 - ring.tables[u][1].bit_count() for t in range(ring.coarse) for u in ring.finer(t)) <= 18


def test_long_bucket_over_many_batches(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUFFER", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    prints = spark.range(3000).select((F.col("id") * 5).alias("fp"))
    want = settled(spark, prints, 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert settled(spark, prints, 2) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_hot_fingerprint_is_split(spark):
    """The rows of a fingerprint that a third of all documents share are joined with its component by several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        text = F.when(F.col("id") % 3 == 0, F.lit("one two three four")).otherwise(F.concat_ws(" ", F.sha1(F.col("id").cast("string")), F.lit("x y")))
        found = simhash.near_duplicates(spark.range(0, 30_000, 1, 8).select(F.xxhash64("id").alias("doc_id"), text.alias("text")))
        assert found.groupBy("component_id").count().agg(F.max("count")).first()[0] == 10_000
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_chain_is_never_stricter_than_distance():
    """Some start's chain passes every pair within the distance; a chain's last prefix is the full check."""
    rng = random.Random(5)
    for distance in (1, 2, 3):
        ring = simhash.Ring(distance)
        for _ in range(500):
            diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, distance + 1)))
            near = diff.bit_count() <= distance
            hit = [i for i, mask in ring.tables if not diff & mask and len(ring.chain(i, np.array([diff], np.uint64)))]
            assert bool(hit) == near


def test_odd_rows(spark):
    ids = [*range(len(ODD) - 1), None]
    rows = simhash.simhash_components(docs(spark, ODD, ids)).collect()
    assert len(rows) == len(ODD)
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {0, 1, 2, 3} and {r.component_id for r in zero} == {0}
    assert {r.component_id for r in rows if r.doc_id in (6, 7, 8)} == {6}
    assert all(len(r.fingerprint) == 16 for r in rows)


def test_near_copies_by_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(300)]
        texts.append(" ".join(base))
        for _ in range(5):
            copy = list(base)
            copy[rng.randrange(300)] = word()
            texts.append(" ".join(copy))
    rows = {r.doc_id: r for r in simhash.simhash_components(docs(spark, texts)).collect()}
    prints = [slow_fingerprint(t) for t in texts]
    assert [int(rows[i].fingerprint, 16) for i in range(len(texts))] == prints
    assert [rows[i].component_id for i in range(len(texts))] == brute(prints, 2)
    kept = simhash.keep_one(docs(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(prints, 2)))


def test_keep_one_columns_and_shared_ids(spark):
    rows = docs(spark, ["p q r s", "p q r s", "t u v w", None], [1, 2, 2, None])
    kept = simhash.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", "p q r s"), ("2", "t u v w"), ("None", "None")]


def test_long_chain_of_links(spark):
    edges = spark.range(1, 3000).selectExpr("id AS u", "id - 1 AS v")
    out = components(edges.repartition(8))
    assert out.count() == 2999 and out.filter("root <> 0").count() == 0


def test_empty(spark):
    assert simhash.simhash_components(docs(spark, [])).count() == 0 and simhash.keep_one(docs(spark, [])).count() == 0
