import hashlib
import random

import pytest

from salesmart.llm.exact import CuckooIndex, exact_dedup, groups, keep_one, live_index

from .cases import ODD, docs


def norm(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_index_against_dict():
    rng, index, live = random.Random(1), CuckooIndex(buckets=1), {}
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for step in range(20_000):
        key = rng.choice(keys)
        if rng.random() < 0.3:
            assert index.delete(key) == (live.pop(key, None) is not None)
        else:
            best, n = live.get(key, (None, 0))
            live[key] = (step if best is None else max(best, step), n + 1)
            index.insert(key, step)
    assert index.live == len(live)
    assert {k: (e[0], e[1]) for k, e in zip(index.keys, index.entries, strict=True) if k is not None} == live
    assert all((index.slot(k) >= 0) == (k in live) for k in keys)


def test_tags_that_agree_are_verified():
    index = CuckooIndex()
    a, b = b"\x01" * 10 + b"a" * 22, b"\x01" * 10 + b"b" * 22      # equal tag and bucket
    index.insert(a, 1)
    assert index.slot(b) < 0 and not index.delete(b)
    index.insert(b, 2)
    assert index.live == 2


def test_full_filter_resizes():
    index = CuckooIndex(buckets=1)
    same = [b"\x07\x07" + bytes(8) + k.to_bytes(22, "big") for k in range(8)]     # two buckets hold eight at most
    for k in range(500):
        index.insert(hashlib.sha256(bytes([k % 256, k // 256])).digest(), k)
    for k in same[:8]:
        index.insert(k, 0)
    assert index.live == 508 and index.mask > 1


def test_odd_rows(spark):
    ids = [*range(len(ODD) - 1), None]
    rows = exact_dedup(docs(spark, ODD, ids)).collect()
    assert len(rows) == len(ODD)
    best = {}
    for i, t in zip(ids, ODD, strict=True):
        best.setdefault(norm(t), []).append(i)
    want = [(i, max([x for x in best[norm(t)] if x is not None], default=None), len(best[norm(t)]),
             hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in zip(ids, ODD, strict=True)]
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows))) == sorted(map(str, want))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)


def test_keep_one(spark):
    texts = ["x", "X", "y", "y", "z", "z", "w", "q", "r"]
    rows = docs(spark, texts, [1, 2, 3, 3, 4, None, None, 2, 3])      # 2 and 3 also with other texts, a repeated row, null ids
    kept = keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "X"), ("2", "q"), ("3", "r"), ("3", "y"), ("4", "z"), ("None", "w")]


def test_index_goes_on(spark):
    first = groups(docs(spark, ["a", "b", "a"]))
    index = live_index(first.select("digest", "doc_id"))
    more = groups(docs(spark, ["b", "c"], [10, 11])).select("digest", "doc_id")
    gone = first.filter("doc_id = 0").select("digest")
    rows = live_index(more, index, gone).collect()
    assert sorted((r.keep_id, r.copies) for r in rows) == [(10, 2), (11, 1)]


def test_empty(spark):
    assert exact_dedup(docs(spark, [])).count() == 0 and keep_one(docs(spark, [])).count() == 0


def test_hot_group(spark):
    rows = spark.range(0, 30_000, numPartitions=8).selectExpr("id AS doc_id", "if(id % 3 = 0, 'Hot', concat('t', id)) AS text")
    out = exact_dedup(rows)
    assert out.filter("kept").count() == 20_001
    assert out.filter("group_size = 10000 and keep_id = 29997").count() == 10_000
