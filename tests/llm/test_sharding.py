import random
import zlib

import pytest

from pyspark.sql import functions as F

from salesmart.llm import sharding
from salesmart.llm.common import table

from .cases import ODD, docs


def slow_best_fit(sizes, capacity):
    rooms, out = [], []
    for size in sizes:
        fits = [(room, k) for k, room in enumerate(rooms) if room >= size and room > 0]
        if fits:
            k = min(fits)[1]
            rooms[k] -= size
        else:
            k = len(rooms)
            rooms.append(capacity - size)
        out.append(k)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_against_brute_force(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 60 if seed % 2 else 9) for _ in range(200)), reverse=True)
    assert list(sharding.best_fit(sizes, 50)) == slow_best_fit(sizes, 50)


@pytest.mark.parametrize("seed", range(10))
def test_pack_takes_the_least_capacity(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 30) for _ in range(60)), reverse=True)
    found = sharding.pack(sizes, 7)
    loads = [sum(s for s, f in zip(sizes, found, strict=True) if f == k) for k in range(7)]
    assert max(found) < 7 and max(loads) - min(loads) <= max(sizes)


def test_a_group_over_its_share_stands_alone():
    found = sharding.pack([1000, 10, 10, 10, 10, 10, 10], 4)
    assert found.count(found[0]) == 1 and max(found) == 3


def check(rows, texts, shards=sharding.SHARDS):
    assert len(rows) == len(texts)
    at, load = {}, [0] * shards
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.size == len(text.encode()) + 16 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.law == "bytes" and r.grown_shard is None and at.setdefault(text, r.shard) == r.shard
        load[r.shard] += r.size
    for k in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
    return load


def test_odd_rows(spark):
    check(sharding.shard_documents(docs(spark, ODD)).collect(), dict(enumerate(ODD)))


def test_real_documents(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents")
    load = check(sharding.shard_documents(rows).collect(), {r.doc_id: r.text for r in rows.collect()})
    assert max(load) < 1.02 * min(load)


def test_parts_of_slots(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    monkeypatch.setattr(sharding, "LOT_GROUPS", 11)
    texts = {k: "hot" if k % 3 == 0 else f"text {k}" * (k % 5) for k in range(600)}
    check(sharding.shard_documents(docs(spark, list(texts.values())), 6).collect(), texts, 6)


def test_row_repeated_for_a_third_of_the_table(spark, monkeypatch):
    """One row's copies are numbered in several parts, gaplessly, each copy once."""
    monkeypatch.setattr(sharding, "SLOT_ROWS", 10)
    ids, texts = [*range(400), *([7] * 200)], [*(f"text {k}" for k in range(400)), *(["text 7"] * 200)]
    rows = sharding.shard_documents(docs(spark, texts, ids), 6).collect()
    assert len(rows) == 600 and sum(r.doc_id == 7 for r in rows) == 201
    for k in range(6):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    one = spark.createDataFrame([(7, 0, 1000)], "doc_id long, shard int, copies long")
    cut = sharding.parts(one, ["doc_id"])
    assert cut.agg(F.sum("__rows"), F.max("__rows"), F.count("*")).first() == (1000, 10, 100)
    assert cut.select("__part").distinct().count() > 40


def test_null_ids_and_empty_table(spark):
    rows = sharding.shard_documents(docs(spark, ["a", "a", "b"], [None, None, 1])).collect()
    assert len(rows) == 3 and {r.slot for r in rows if r.doc_id is None} == {0, 1}
    assert sharding.shard_documents(docs(spark, [])).count() == 0
