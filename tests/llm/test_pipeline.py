import hashlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from salesmart.llm import bpe, quality
from salesmart.llm.common import table
from salesmart.llm.oracle import ORACLE
from salesmart.llm.queries import QUERIES

from .cases import docs
from .test_exact import norm
from .test_simhash import brute, slow_fingerprint

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_brute_force(spark):
    """Each stage's decision made anew, one document after the other; the classifier's is its query's."""
    rows = {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").collect()}
    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    good = {r.doc_id for r in quality.quality(table(spark, SMALL, "documents")).collect() if r.accepted}
    last = {norm(rows[i]): i for i in sorted(good)}
    kept = sorted(last.values())
    kept = [kept[k] for k in sorted(set(brute([slow_fingerprint(rows[i]) for i in kept], 2)))]
    kept = [i for i in kept if not any(x in rows[i] for x in items)]
    library = Tokenizer.from_file(bpe.default_path())
    want = set()
    for i in kept:
        ids = np.array(library.encode(rows[i], add_special_tokens=False).ids, "<u4").tobytes()
        want.add((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(rows[i].encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert set(got) == want and len(got) == len(want) < len(rows)


def test_stages_keep_the_columns(spark):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    own = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, own, SMALL).schema.names == own.schema.names


def test_odd_documents(spark):
    text = "The quick fox is in the garden and it was for you."
    for rows in (docs(spark, []), docs(spark, [None, "", text, text.upper(), text], [None, 1, 2, 3, 2])):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SMALL).count() <= 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{MORE}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, MORE).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
