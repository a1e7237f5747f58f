import random

import pytest

from salesmart.llm import decontaminate as dec
from salesmart.llm.common import table

from .cases import ODD, docs

ITEM = "If Anna buys 12 kg of flour for $30 and Anna sells 5 kg, how much flour does Bernd keep"


def bench(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts, strict=True)], "item_id long, text string, key string")


def found(spark, texts, items, **more):
    return {(r.doc_id, r.item_id): r for r in dec.matches(docs(spark, texts), bench(spark, items), **more).collect()}


def test_templates():
    hashes, slot, words = dec.template("Ask Anna: 3.5 km in 20%, km? Yes Anna")
    assert [w for w, s in zip(words, slot, strict=True) if s] == ["Anna", "3.5", "km", "20", "%", "Anna"]
    assert len(hashes) == len(words) == 10
    assert dec.template("")[0].size == 0


@pytest.mark.parametrize("text, hit, changed", [
    (f"before it. {ITEM}. after", True, 0),
    (ITEM.replace("Anna", "Clara").replace("12", "99").replace("5", "7").replace("30", "41"), True, 4),
    (ITEM.replace("Anna", "Clara", 1), False, None),                       # one name, two values
    (ITEM.replace("Anna", "Clara").replace("Bernd", "Clara"), False, None),
    (ITEM.upper().replace("KG", "kg"), False, None),                       # names are no longer slots
    ("a wholly different text about 12 kg of something else that Anna has", False, None),
    (ITEM[:30], False, None),
])
def test_slots(spark, text, hit, changed):
    got = found(spark, [text], [ITEM])
    assert ((0, 0) in got) == hit and (not hit or got[0, 0].changed_slots == changed)


def test_against_substrings(spark):
    """On the given tables the items are in the documents word for word or not at all."""
    documents, benchmark = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "benchmark"))
    items = benchmark.collect()
    want = {(d.doc_id, i.item_id) for d in documents.collect() for i in items if d.text and i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in dec.contaminated(documents, benchmark).collect()}
    assert got == want and want


def slow(texts, items):
    """Pairs by the definition, over lower-case words without slots."""
    out = {}
    for i, t in enumerate(texts):
        own = t.split()
        for j, item in enumerate(items):
            words = item.split()
            width = min(dec.WINDOW, len(words))
            hits = {k for k in range(len(words) - width + 1) if any(own[a:a + width] == words[k:k + width] for a in range(len(own)))}
            total = len({k for k in range(len(words) - width + 1)})
            if total and len(hits) >= dec.COVERAGE * total:
                out[i, j] = (len(hits), total)
    return out


@pytest.mark.parametrize("sent", [dec.MAX_SENT, 0])
def test_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(dec, "MAX_SENT", sent)
    rng = random.Random(4)
    word = lambda: rng.choice("red blue green black white grey pink".split())
    items = [" ".join(word() for _ in range(rng.choice([1, 3, 4, 5, 9, 20]))) for _ in range(12)]
    texts = []
    for k in range(60):
        body = [word() for _ in range(rng.randrange(40))]
        if k % 3 == 0:
            own = rng.choice(items).split()
            if k % 2:
                own[rng.randrange(len(own))] = "changed"
            body[3:3] = own
        texts.append(" ".join(body))
    assert {k: (r.matched, r.windows) for k, r in found(spark, texts, items).items()} == slow(texts, items)


def test_odd_rows(spark):
    texts, ids = [*ODD, ITEM, ITEM], [*range(len(ODD)), None, 99]
    benchmark = bench(spark, [ITEM, ITEM, None, "", ITEM], [1, 1, 2, 3, None])
    got = dec.matches(docs(spark, texts, ids), benchmark).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in got] == [(99, 1, 1.0)]
    kept = dec.keep_clean(docs(spark, texts, ids), benchmark)
    assert kept.count() == len(ODD) and kept.columns == docs(spark, texts, ids).columns
    assert dec.matches(docs(spark, []), benchmark).count() == 0
    assert dec.matches(docs(spark, texts), bench(spark, [])).count() == 0
    assert dec.keep_clean(docs(spark, texts), bench(spark, [])).count() == len(texts)


SUM = ("If Anna buys 12 eggs at the small shop and then sells 5 eggs at the large market, "
       "how many eggs does she have out of the 12 that she took home")
NOUNS = ("wenn der alte Hund am frühen morgen durch den Garten läuft und dann der kleine Hund noch einmal zu ihm kommt "
         "so bleibt der müde Hund ganz still und schläft bis zum späten abend weiter")


@pytest.mark.parametrize("text, item, changed", [
    (SUM.replace("12", "7").replace("5", "7"), SUM, 2),      # two numbers became one
    (SUM.replace("12", "99", 1), SUM, 0),                     # one of two places edited
    (NOUNS.replace("Hund", "Hahn", 1), NOUNS, 0),             # one of three places edited
])
def test_slot_conflicts(spark, text, item, changed):
    got = found(spark, [text], [item])
    assert (0, 0) in got and got[0, 0].changed_slots == changed


JANET = "Janet has 16 eggs in the box. Janet eats 3 of them and then sells the rest at the market for 2 dollars"


@pytest.mark.parametrize("text, item, changed", [
    (JANET.replace("Janet", "Clara").replace("16", "9"), JANET, 2),
    (f"and so on 12) {JANET}", JANET, 0),
    ("and so on Janet eats a lot of green eggs too", "Janet eats a lot of green eggs", 0),
    (f"it says: {ITEM}", ITEM.replace("If Anna", "Anna"), 0),
    ("The end. When Anna sells. Bernd buys. Clara eats. Then", "When Clara sells. Anna buys. Bernd eats. Then", 3),
])
def test_names_that_open_a_sentence(spark, text, item, changed):
    got = found(spark, [text], [item])
    assert (0, 0) in got and got[0, 0].changed_slots == changed


def test_readings():
    """All readings of all windows, by the definition, of texts read together."""
    texts = ["Anna. Bernd. Clara. Doris. Emil. So it goes", "", "One two", "It is. Anna and. Bernd or 3 km. The. End of it all"]
    own = dec.Readings(texts)
    for width, literals in ((1, 1), (2, 2), (5, 2), (5, 0)):
        got = sorted((a, b) for a, _, b in zip(*(x.tolist() for x in own.windows(width, literals)), strict=True))
        want = []
        for a in range(len(own.of) - width + 1):
            if own.of[a] == own.of[a + width - 1]:
                fixed = sum(1 << k for k in range(width) if own.slot[a + k])
                want += [(a, b) for b in range(1 << width) if all(own.either[a + k] for k in range(width) if b >> k & 1)
                         and width - (fixed | b).bit_count() >= literals]
        assert got == sorted(want)


SERIES = "Go on with the series 3 5 8 13 21 34 55 89 144 233 377 610"
MIXED = "Then the boy paid 12 Euro 5 Cent to Anna Bernd and then he went back to the house"


@pytest.mark.parametrize("text, item, hit", [
    ("so 12 + 30 = 42 it is", "12 + 30 = 42", True),
    ("so 12 + 31 = 43 it is", "12 + 30 = 42", False),
    ("now Compute 12 + 30 * 4 then", "Compute 12 + 30 * 4", True),
    ("with 7 8 9 10 11 12 13 in it", "7 8 9 10 11 12", True),
    ("with Anna Bernd Clara Doris Emil Fritz in it", "Anna Bernd Clara Doris Emil Fritz", True),
    (f"so {SERIES} and", SERIES, True),
    ("Go on with the series 4 6 9 14 22 35 56 90 145 234 378 611", SERIES, False),    # most of the item is another
    (MIXED.replace("12", "9").replace("Anna", "Clara").replace("Bernd", "Doris"), MIXED, True),
])
def test_windows_without_literals(spark, text, item, hit):
    got = found(spark, [text], [item])
    assert ((0, 0) in got) == hit
    if hit:
        assert got[0, 0].windows == max(1, len(dec.template(item)[0]) - dec.WINDOW + 1)


def test_covered():
    assert dec.covered(set()) == [] and dec.covered({0, 2, 7, 13}) == [*range(8), 13]


def hot(spark, n):
    """Texts and items that share ten words, and some pairs that share all."""
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4))
    common = "the quick answer to this kind of question is always"
    items = [f"{name()} {name()} {name()} {name()} {common} {name()} {name()} {name()} {name()} {name()} {name()} {name()}" for _ in range(n)]
    texts = [f"{name()} {name()} {common} {name()} {name()}" + (f" so {items[k]} then" if k % 10 == 0 else "") for k in range(n)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return documents, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_common_window_is_no_product(spark, monkeypatch):
    documents, items = hot(spark, 300)
    rows = []
    met = dec._met

    def counted(*args):
        out = met(*args)
        rows.append(out.count())
        return out
    monkeypatch.setattr(dec, "_met", counted)
    got = {(r.doc_id, r.item_id) for r in dec.contaminated(documents, items).collect()}
    assert got == {(k, k) for k in range(0, 300, 10)} and rows[0] < 10 * 600


def test_shared_windows_change_no_result(spark, monkeypatch):
    documents, items = hot(spark, 60)
    # items that are nearly all shared windows, and the given tables
    more = spark.createDataFrame([(1000 + k, "the quick answer to this kind of question is always here") for k in range(20)], items.schema)
    some = [(documents, items.unionByName(more)), tuple(table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))]

    def found():
        return [sorted(map(tuple, dec.contaminated(d, b).collect())) for d, b in some]
    monkeypatch.setattr(dec, "SHARED_ITEMS", 10_000_000)
    plain = found()
    for limit in (0, 1, 16):
        monkeypatch.setattr(dec, "SHARED_ITEMS", limit)
        assert found() == plain
    assert plain[0] and plain[1]
