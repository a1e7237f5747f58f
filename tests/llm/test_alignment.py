import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from salesmart.llm import alignment
from salesmart.llm.bpe import byte_symbols
from salesmart.llm.common import table

from . import cases


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(alignment.default_a())
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=alignment.default_b())


def slow(rows, library):
    """The contract, token by token and link by link."""
    tok, sp = library
    symbols = byte_symbols()
    own, links, held = {}, {}, defaultdict(int)
    for at, (_, text) in enumerate(rows):
        a = b = []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            as_bytes = [bytes(symbols[c] for c in tok.id_to_token(i)) for i in a]
            bs_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(as_bytes) == b"".join(bs_bytes) == (" " + text).encode():
                a = b = []
        groups, i, j, x, y = [], 0, 0, 0, 0
        left, right = [], []
        while i < len(a) or j < len(b):
            if x <= y and i < len(a):
                x += len(as_bytes[i])
                left.append(a[i])
                i += 1
            else:
                y += len(bs_bytes[j])
                right.append(b[j])
                j += 1
            if x == y:
                groups.append((left, right))
                left, right = [], []
        own[at] = (len(a), len(b), groups)
        links[at] = Counter()
        for p, q in groups:
            for s in p:
                for t in q:
                    links[at][s, t] += 1
        for pair in links[at]:
            held[pair] += 1
    top = defaultdict(int)
    for (s, _), n in held.items():
        top[s] = max(top[s], n)
    out = []
    for at, (doc_id, _) in enumerate(rows):
        n_a, n_b, groups = own[at]
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((doc_id, n_a, n_b, len(groups), sum(links[at].values()),
                    sum(k for (s, t), k in links[at].items() if held[s, t] == top[s]),
                    sum(k * held[pair] for pair, k in links[at].items()), hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return out


def check(spark, rows, library):
    df = cases.docs(spark, [t for _, t in rows], [i for i, _ in rows])
    got = alignment.alignment_digests(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, slow(rows, library)))


def test_odd_texts(spark, library):
    rows = [(i, t) for i, t in enumerate(cases.ODD) if t != cases.LONG]
    rows += [(None, "one two"), (3, "one two"), (3, "one two"), (90, "▁ a"), (91, "<s> <unk> <0x41>"), (92, "a  b   c\n\n d"), (93, " x"), (94, "ﬁ Å ①")]
    check(spark, rows, library)


def test_random_texts(spark, library):
    rng = random.Random(3)
    alphabets = ["ab ", "aAbB \n", "0123456789 .", "é\U0001F600中 ", "'sdt mlre", "=-_/<>", "日本語テキスト ", "\t\n a"]
    check(spark, [(i, "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(200)))) for i in range(300)], library)


def test_very_long_text(spark, library):
    check(spark, [(1, cases.LONG), (2, cases.LONG), (3, "soup")], library)


def test_wide_groups_count_alike(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 200), rng.integers(0, 4, 180)
    of_a, of_b = np.sort(np.r_[0:6, rng.integers(0, 6, 194)]), np.sort(np.r_[0:6, rng.integers(0, 6, 174)])

    def totals():
        out = Counter()
        for g, s, t, n in zip(*(x.tolist() for x in alignment._links(a, b, of_a, of_b, 6)), strict=True):
            out[g, s, t] += n
        return out
    each = totals()
    monkeypatch.setattr(alignment, "WIDE", 1)
    assert totals() == each and sum(each.values()) == sum(int((of_a == g).sum() * (of_b == g).sum()) for g in range(6))


def test_small_chunks_give_the_same(spark, library, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_TEXTS", 2)
    check(spark, [(i, " ".join("word tion er ing the".split()[: 1 + i % 5]) * (1 + i % 3)) for i in range(40)], library)


def test_pairs(spark):
    _, pairs = alignment.align(cases.docs(spark, ["aa bb", "aa bb", "aa"]))
    rows = pairs.collect()
    assert {r.n for r in rows} == {2, 3} and all(r.best for r in rows)


def test_packing():
    numbers = np.array([0, 1, 255, 256, 1 << 40, 7], np.int64)
    for some in (numbers, numbers[:3], numbers[:0]):
        assert alignment.unpack(alignment.pack(some)).tolist() == some.tolist()


def test_a_side_is_the_library(library):
    with open(alignment.default_a(), "rb") as f:
        side = alignment.ByteLevel(f.read())
    rng = random.Random(9)
    texts = [f"{chr(c)}a{chr(c)}{chr(c)} {chr(c)}" for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choice("aab \n'0=") for _ in range(rng.randrange(80))) for _ in range(5000)] + ["x" * 5000, " " * 3000 + "a"]
    want = [e.ids for e in library[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in side.encode(texts)] == want


def test_empty(spark):
    assert alignment.alignment_digests(cases.docs(spark, [])).count() == 0
    assert [r.n_links for r in alignment.alignment_digests(cases.docs(spark, [None, "", "▁ a"])).collect()] == [0, 0, 0]


def test_query_against_slow_version(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = alignment.alignment_digests(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, slow(rows, library)))
