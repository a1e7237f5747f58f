import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from salesmart.llm.common import table
from salesmart.llm.tokencount import Counter, Vocabulary, read_vocabulary, token_counts

from .cases import ODD, docs


def library(vocabulary):
    names = [p for p, _ in vocabulary.pieces]
    t = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=names.index(vocabulary.unknown), byte_fallback=vocabulary.byte_pieces))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(t.encode(text, add_special_tokens=False).ids) if text else 0


def test_real_documents(spark):
    texts = [t for t in ODD if t is None or len(t) < 1000] + [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    count = library(read_vocabulary())
    got = {r.doc_id: r.n_tokens for r in token_counts(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [count(t) for t in texts]


#: many ties, and pieces that cross marks in the second
TIED = Vocabulary((("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -2.0), ("▁a", -2.0), ("▁ab", -3.0)),
                  "<unk>", False)
CROSSING = Vocabulary((*TIED.pieces, ("a▁b", -1.5), ("b▁", -1.0)), "<unk>", False)


@pytest.mark.parametrize("vocabulary", [TIED, CROSSING])
def test_ties_and_unknowns(vocabulary):
    counter, count = Counter(vocabulary), library(vocabulary)

    @settings(max_examples=400, deadline=None)
    @given(st.text("ab é", max_size=25))
    def same(text):
        assert counter.text(text)[1] == count(text)
    same()


def test_other_rows(spark):
    assert token_counts(docs(spark, [])).count() == 0
    assert token_counts(docs(spark, ["a", "a"], [None, None])).count() == 2
