import hashlib
import random
import zlib

import duckdb
import pytest

from salesmart.llm import runs
from salesmart.llm.common import table

from . import cases


def slow_runs(words, least):
    """Every (start, period) tried; a period counts if no smaller one holds on the same stretch."""
    out = []
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, length = i, j + q - i
            stretch = words[s:s + length]
            if length >= max(least, 2 * q) and not any(all(stretch[k] == stretch[k + e] for k in range(length - e)) for e in range(1, q)):
                out.append((s, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words, 12)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("least", [2, 3, 5, 12])
@pytest.mark.parametrize("letters", [1, 2, 3])
def test_random_words(least, letters):
    rng = random.Random(least * 10 + letters)
    texts = [[b"%d" % rng.randrange(letters) for _ in range(rng.randrange(80))] for _ in range(120)]
    assert runs.find_runs(texts, least) == [slow_runs(t, least) for t in texts]


def test_planted_periods():
    rng = random.Random(5)
    texts = []
    for k in range(150):
        unit = [b"%d" % rng.randrange(2 + k % 40) for _ in range(1 + k % 23)]
        texts.append([b"x%d" % rng.randrange(9) for _ in range(rng.randrange(30))] + unit * rng.randrange(2, 9) + unit[:rng.randrange(len(unit))]
                     + [b"y%d" % rng.randrange(9) for _ in range(rng.randrange(30))])
    assert runs.find_runs(texts) == [slow_runs(t, 12) for t in texts]


def test_texts_searched_apart(monkeypatch):
    texts = [[b"a", b"b"] * k for k in range(12)] + [[b"a"] * 40]
    whole = runs.find_runs(texts)
    monkeypatch.setattr(runs, "WORDS_AT_ONCE", 10)
    assert runs.find_runs(texts) == whole == [slow_runs(t, 12) for t in texts]


def test_large_class_is_held_in_blocks():
    n = 30_000
    assert runs.find_runs([[b"a"] * n + [b"b"] + [b"a"] * n]) == [[(0, n, 1), (n + 1, n, 1)]]


def test_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 500:
        a, b = b, b + a
    assert runs.find_runs([b], 4) == [slow_runs(b, 4)]


def test_operator_output(spark):
    df = cases.docs(spark, ["x y z " + "a b c " * 5 + "end", None, "p q"], [5, 6, 7])
    rows = {r.doc_id: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in rows[5].runs] == [(2, 15, 3)] and rows[5].collapsed == "x y z a b c end"
    assert rows[6].runs == [] and rows[6].collapsed == "" and rows[7].collapsed == "p q"


def test_odd_texts(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0 or i < 16]
    texts = [cases.ODD[k % len(cases.ODD)] for k in range(len(ids))]
    short = [(i, t) for i, t in zip(ids, texts, strict=True) if t != cases.LONG] + [(None, "a " * 20), (3, "one two"), (3, "one two")]
    got = runs.run_digests(cases.docs(spark, [t for _, t in short], [i for i, _ in short])).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(slow_row(i, t)) for i, t in short)


def test_very_long_text(spark):
    row = runs.run_digests(cases.docs(spark, [cases.LONG], [1])).first()      # 20,000 times three words, and one
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 60_000, 3, 20_000_000)


def test_empty(spark):
    assert runs.run_digests(cases.docs(spark, [])).count() == 0


def test_query_against_slow_version(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' WHERE length(text) < 6000").fetchall()
    docs = table(spark, "/root/testdata/sf0.001", "documents").filter("text IS NULL OR length(text) < 6000")
    got = runs.run_digests(docs).collect()
    assert sum(r.n_runs > 0 for r in got) > 10
    assert sorted(map(str, map(tuple, got))) == sorted(str(slow_row(*r)) for r in rows)
