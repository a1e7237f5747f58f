import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesmart.llm import bpe
from salesmart.llm.common import table

from .cases import LONG, ODD, docs


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def codec():
    with open(bpe.default_path(), "rb") as f:
        return bpe.Codec(f.read())


def ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_like_the_library(library, codec, text):
    packed = codec.encode_batch([text])[0]
    assert packed == ids(library, text) and codec.decode(packed) == text


def test_all_characters(library, codec):
    texts = ["".join(f"{chr(c)} a{chr(c)}{chr(c)}" for c in range(s, s + 512) if not 0xD800 <= c < 0xE000) for s in range(0, 0x30000, 512)]
    assert codec.encode_batch(texts) == [ids(library, t) for t in texts]


@pytest.mark.parametrize("piece", [b"a", b"aaaaaaa", b"thethethe", b"\xff\xfe", b"x" * 33, b"ab" * 20_000])
def test_one_tree_and_many(codec, piece):
    one = bpe._packed(codec.merge(piece))
    if len(piece) <= 32:
        assert codec.merge_many([piece, b"zz", piece], 32)[0] == one
    assert codec.decode(one) == piece.decode("utf-8", "replace")


def test_cache_starts_anew(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    texts = ["one two three four five", "six seven eight one two"]
    assert codec.encode_batch(texts) + codec.encode_batch(texts[::-1]) == [ids(library, t) for t in texts + texts[::-1]]


def test_query(spark, library):
    real = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts = ODD + real
    got = {r.doc_id: r for r in bpe.token_digests(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        packed = ids(library, t)
        back = library.decode(list(np.frombuffer(packed, "<u4")), skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_other_rows(spark):
    assert bpe.token_digests(docs(spark, [])).count() == 0
    assert bpe.token_digests(docs(spark, ["a", "a", LONG], [None, None, 1])).count() == 3
    packed = spark.createDataFrame([(1, None), (2, bytes([255, 0, 0, 0]))], "doc_id long, ids binary")
    assert sorted(r.decoded for r in bpe.decode(packed).collect())[0] == ""
