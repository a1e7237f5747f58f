"""Benchmark decontamination by template windows (operator 8).

Texts become templates: numbers, names (capitalised words) and units (after a number)
turn into typed placeholders, other words are lower-cased, signs go. A capitalised word that opens a sentence or a text
is read both ways, as a name and as a literal word; either may meet. Windows of ``WINDOW`` template
tokens are hash-joined with those of the benchmark. Hits of a document and an item with the same offset
form an alignment; in it each value of the item stands for one value of the document (``refused``), and
windows that say otherwise are dropped, so a question asked anew with other numbers or names still
counts, one with a few edited places too, and a chance meeting of templates does not. A pair is reported if the
windows left cover at least ``COVERAGE`` of the item's windows.

The documents' windows are filtered against the benchmark's before they are shuffled while the
benchmark has at most ``MAX_SENT`` windows; beyond that all windows meet in the join.

Windows of fewer than ``LITERALS`` literal words (all words of a shorter item) would meet everywhere as templates. They meet
by their lower-case words as they are, or count as met if all their words lie in windows that are met. So a longer run
of numbers and names has to be the same.

Defined results: null and empty texts have no windows; an item shorter than a window is one window; an item without a
word, number or unit is never matched; repeated rows share one result row, and so do repeated items; rows and items without an id are
left out. Whole texts are read. Columns other than the named ones are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesmart.llm.common import shared, whole

WINDOW = 5
LITERALS = 2
COVERAGE = 0.8
MAX_SENT = 2_000_000       # benchmark windows (8 bytes each) that every task is sent
SHARED_ITEMS = 16          # items from which a window of theirs is met last; changes no result
CACHED_WORDS = 200_000
CHUNK = 1 << 16            # characters of short texts that are read together
#: Units of measurement looked for after a number.
UNITS = frozenset((
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound "
    "pounds oz ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years dollar dollars cent cents euro euros usd eur gbp percent degree "
    "degrees mph kmh kph watt watts volt volts % $ € £ °").split())
_tokens = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%$€£°]|[.!?:;\n\"“”]").findall
WORD, NAME, NUMBER, UNIT, SIGN, STOP = range(6)
_BASE = np.uint64(0x9E3779B97F4A7C15)
EXACT = -1                 # in place of a reading's bits
HIT = "key {kind}, at int, hash long, slots array<struct<at:int,value:string,sure:boolean>>"


class Tokens(dict):
    """(hash, class, text in lower case) rows of tokens; bounded between texts."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.hash, self.kind = np.zeros(1024, np.uint64), np.zeros(1024, np.int8)

    def __missing__(self, token: str) -> int:
        at = self[token] = len(self)
        if at == len(self.hash):
            self.hash, self.kind = np.r_[self.hash, self.hash], np.r_[self.kind, self.kind]
        low, first = token.lower(), token[0]
        if first.isdigit():
            kind = NUMBER
        elif first.isalpha():
            kind = NAME if len(token) > 1 and first.isupper() and token[1:].islower() else UNIT if low in UNITS else WORD
        else:
            kind = SIGN if low in UNITS else STOP
        self.hash[at], self.kind[at] = xxhash.xxh64_intdigest(low, seed=1), kind
        return at


_PLACEHOLDER = np.array([0, *(xxhash.xxh64_intdigest(p) for p in ("<name>", "<number>", "<unit>"))], np.uint64)
_table: list[Tokens] = []


class Readings:
    """The template tokens of some texts, one after the other. A capitalised word that opens a sentence or a text may be a
    name or not: its own reading is literal, ``either`` marks it."""

    def __init__(self, texts: list[str]):
        if not _table:
            _table.append(Tokens())
        table = _table[0]
        if len(table) > CACHED_WORDS:
            table.clear()
        found, ends = [], []
        for text in texts:
            found += _tokens(text)
            ends.append(len(found))
            found.append("\n")                # a stop: the next text's first word opens it
        at = np.fromiter(map(table.__getitem__, found), np.int64, len(found))
        hashes, kind = table.hash[at], table.kind[at].copy()
        before = np.r_[np.int8(STOP), kind[:-1]][:len(kind)]
        opens = (kind == NAME) & (before == STOP)
        kind[opens | (kind == UNIT) & (before != NUMBER)] = WORD
        kind[kind == SIGN] = np.where(before[kind == SIGN] == NUMBER, UNIT, STOP)
        slot = (kind > WORD) & (kind < SIGN)
        kept = np.flatnonzero(kind != STOP)
        self.hashes = np.where(slot, _PLACEHOLDER[np.where(slot, kind, 0)], hashes)[kept]
        self.slot, self.either, self.words = slot[kept], opens[kept], hashes[kept]
        self.of = np.searchsorted(np.array(ends, np.int64), kept)            # the text of each token
        self.starts = np.searchsorted(self.of, np.arange(len(texts) + 1))
        self._found, self._kept = found, kept

    def word(self, at: int) -> str:
        return self._found[self._kept[at]]

    def windows(self, width: int, literals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, hash and places taken for names (a bit each) of every reading of ``width`` tokens of one text that has
        enough literal words."""
        n = len(self.hashes) - width + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h, words, open_ = np.full(n, width, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in range(width):
            h = _mix(h, self.hashes[k:k + n])
            words += ~self.slot[k:k + n]
            open_ += self.either[k:k + n]
        one_text = self.of[:n] == self.of[width - 1:]
        at = np.flatnonzero(one_text & (words >= literals))
        # the other readings: each place that is either goes both ways
        more = np.flatnonzero(one_text & (open_ > 0) & (words > literals))
        hm, left, bits = np.full(len(more), width, np.uint64), words[more], np.zeros(len(more), np.int64)
        for k in range(width):
            both = np.flatnonzero(self.either[more + k] & (left > literals))
            tokens = np.r_[self.hashes[more + k], np.full(len(both), _PLACEHOLDER[NAME])]
            more, hm = np.r_[more, more[both]], _mix(np.r_[hm, hm[both]], tokens)
            left, bits = np.r_[left, left[both] - 1], np.r_[bits, bits[both] | 1 << k]
        named = np.flatnonzero(bits)
        return np.r_[at, more[named]], np.r_[h[at], hm[named]], np.r_[np.zeros(len(at), np.int64), bits[named]]

    def exact(self, width: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash over the lower-case words, without placeholders, of every window that has a reading of too few
        literal words."""
        n = len(self.hashes) - width + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sure = np.cumsum(np.r_[0, ~self.slot & ~self.either])
        at = np.flatnonzero((self.of[:n] == self.of[width - 1:]) & (sure[width:] - sure[:n] < literals))
        h = np.full(len(at), WINDOW + width, np.uint64)
        for k in range(width):
            h = _mix(h, self.words[at + k])
        return at, h

    def slots(self, at: int, width: int, bits: int) -> list[dict]:
        """A reading's slot values (places within the window); ``sure``: in every reading. An exact window has none."""
        if bits == EXACT:
            return []
        return [{"at": k, "value": self.word(at + k).lower(), "sure": not bits >> k & 1}
                for k in range(width) if self.slot[at + k] or bits >> k & 1]


def _mix(h: np.ndarray, token: np.ndarray) -> np.ndarray:
    h = (h ^ token) * _BASE
    return h ^ h >> np.uint64(29)


def template(text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Hashes of the tokens of the template's literal reading, which of them are slots, and their texts."""
    own = Readings([text])
    return own.hashes, own.slot, [own.word(k) for k in range(len(own.hashes))]


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    slots = pa.list_(pa.struct([("at", pa.int32()), ("value", pa.string()), ("sure", pa.bool_())]))
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (kind, pa.int32(), pa.int64(), slots), strict=True)],
                                      ["key", "at", "hash", "slots"])


def _windowed(df: DataFrame, key: str, text: str, widths: list[int], short: bool, sent=None) -> DataFrame:
    """Windows of each text: key, place, hash and slot values (places within the window). ``short``: a text shorter
    than a window is one window of its own. ``sent``: the sorted hashes that are looked for."""
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), whole(text).alias("text"))
    kind = to_arrow_type(df.schema[key].dataType)

    def chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
        names, texts, n = [], [], 0
        for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            names.append(name)
            texts.append(t)
            n += len(t)
            if n > CHUNK:
                yield names, texts
                names, texts, n = [], [], 0
        if names:
            yield names, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, texts in (c for batch in batches for c in chunks(batch)):
            own, out = Readings(texts), []
            sizes = np.diff(own.starts)
            for width in (range(1, WINDOW + 1) if short else widths):
                at, h, bits = own.windows(width, min(width, LITERALS))
                exact, words = own.exact(width, min(width, LITERALS))
                at, h, bits = np.r_[at, exact], np.r_[h, words], np.r_[bits, np.full(len(exact), EXACT)]
                if short:
                    some = np.minimum(sizes, WINDOW)[own.of[at]] == width
                    at, h, bits = at[some], h[some], bits[some]
                if sent is not None and len(at):
                    wanted = sent.value
                    hit = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
                    at, h, bits = at[hit], h[hit], bits[hit]
                of = own.of[at]
                for text, place, a, x, named in zip(of.tolist(), (at - own.starts[of]).tolist(), at.tolist(), h.view(np.int64).tolist(),
                                                    bits.tolist(), strict=True):
                    out.append((names[text], place, x, own.slots(a, width, named)))
                    if len(out) > 20_000:
                        yield _rows(out, kind)
                        out = []
            if out:
                yield _rows(out, kind)
    return rows.mapInArrow(run, HIT.format(kind=df.schema[key].dataType.simpleString()))


def refused(slots: dict[tuple[str, str], set[int]], sure: set[tuple[str, str]]) -> set[tuple[str, str]]:
    """The pairs (item's value, document's value) that don't hold, of an alignment's pairs and their places in the item;
    ``sure``: pairs that are slots in every reading somewhere.

    A value of the item stands for the document's value that most of its places have, a sure one before others. Among equals,
    a number or unit stands for the first in order and a name for none. Two sure names of the item that became one name stand
    for none; numbers may coincide."""
    by: dict[str, list[tuple[str, str]]] = {}
    for pair in slots:
        by.setdefault(pair[0], []).append(pair)
    bad = set()
    for value, pairs in by.items():
        if len(pairs) > 1:
            rank = lambda p: (-len(slots[p]), p not in sure)
            pairs.sort(key=lambda p: (rank(p), p))
            tie = rank(pairs[0]) == rank(pairs[1])
            bad.update(pairs if tie and _is_name(value) else pairs[1:])
    names: dict[str, list[tuple[str, str]]] = {}
    for pair in slots:
        if pair not in bad and pair in sure and _is_name(pair[0]):
            names.setdefault(pair[1], []).append(pair)
    for pairs in names.values():
        if len(pairs) > 1:
            bad.update(pairs)
    return bad


def covered(places: set[int]) -> list[int]:
    """All windows whose every word lies in one of the windows at ``places``."""
    out: list[int] = []
    for at in sorted(places):
        out += range(out[-1] + 1 if out and at - out[-1] <= WINDOW else at, at + 1)
    return out


def _is_name(value: str) -> bool:
    return value[0].isalpha() and value not in UNITS


def _agreed(aligned: DataFrame) -> DataFrame:
    """``key, item, places, changed`` of each alignment: the item's windows that carry no refused pair and those that
    they cover, and how many of their pairs differ."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, changed = [], []
            for hits in batch.column(2):
                hits = [(h["at"], [(s["at"], (s["i"], s["d"]), s["sure"]) for s in h["slots"]]) for h in hits.as_py()]
                slots: dict[tuple[str, str], set[int]] = {}
                for _, own in hits:
                    for at, pair, _ in own:
                        slots.setdefault(pair, set()).add(at)
                bad = refused(slots, {pair for _, own in hits for _, pair, sure in own if sure})
                kept = [(at, own) for at, own in hits if not any(pair in bad for _, pair, _ in own)]
                places.append(covered({at for at, _ in kept}))
                changed.append(len({pair for _, own in kept for _, pair, _ in own if pair[0] != pair[1]}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32())),
                                              pa.array(changed, pa.int32())], ["key", "item", "places", "changed"])
    kinds = [aligned.schema[c].dataType.simpleString() for c in ("key", "item")]
    return aligned.mapInArrow(run, f"key {kinds[0]}, item {kinds[1]}, places array<int>, changed int")


def _met(hits: DataFrame, wanted: DataFrame, sizes: DataFrame, coverage: float) -> DataFrame:
    """``hits`` with the items' windows of the same hash, for the pairs that can reach ``coverage``.

    A window of more than ``SHARED_ITEMS`` items says little, and meeting them all through it would give a row for
    each text and item that hold it. Where an item's shared windows can't cover it alone, a text has to hold another of
    its windows too: such pairs are found by those, and only they meet the shared ones, by item and text."""
    often = wanted.groupBy("hash").agg(F.countDistinct("item").alias("n")).filter(F.col("n") > SHARED_ITEMS).select("hash", F.lit(True).alias("often"))
    marked = shared(wanted.join(often, "hash", "left").withColumn("often", F.coalesce("often", F.lit(False))), "marked")

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone = [len(covered(set(places))) >= coverage * n for places, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield batch.filter(pa.array(alone, pa.bool_())).select(["item"])
    kind = wanted.schema["item"].dataType.simpleString()
    places = marked.filter("often").groupBy("item").agg(F.collect_set("item_at").alias("places")).join(sizes, "item")     # of one item
    alone = places.select("item", "places", "windows").mapInArrow(enough, f"item {kind}").withColumn("alone", F.lit(True))
    marked = shared(marked.join(alone, "item", "left").withColumn("late", F.col("often") & F.col("alone").isNull()).drop("often", "alone"), "marked")
    first = shared(hits.join(marked.filter("not late").drop("late"), "hash"), "met")
    pairs = first.select("key", "item").distinct()
    later = pairs.join(marked.filter("late").drop("late"), "item")
    again = hits.join(later, ["key", "hash"])
    return first.unionByName(again.select(first.columns))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
            item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``key, item, windows, matched, coverage, changed_slots`` of the contaminated pairs."""
    spark = docs.sparkSession
    wanted = shared(_windowed(benchmark, item, item_text, [], True).select(
        F.col("key").alias("item"), F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots")), "windows")
    sizes = wanted.groupBy("item").agg(F.countDistinct("item_at").alias("windows"))
    # an item shorter than a window has one of its own length: at most WINDOW widths in all
    widths = sorted({WINDOW} | {r[0] for r in _widths(benchmark, item, item_text).collect()})
    distinct, sent = wanted.select("hash").distinct(), None
    n = distinct.count()
    if n <= MAX_SENT:
        hashes = [r[0] for r in distinct.collect()] or [0]      # a chance hit would still meet nothing in the join
        sent = spark.sparkContext.broadcast(np.sort(np.array(hashes, np.int64).view(np.uint64)))
    hits = shared(_windowed(docs, key, text, widths, False, sent), "hits")
    met = _met(hits, wanted, sizes, coverage).select("key", "item", (F.col("at") - F.col("item_at")).alias("offset"), F.struct(
        F.col("item_at").alias("at"), F.zip_with("item_slots", "slots", lambda i, d: F.struct(
            (F.col("item_at") + i["at"]).alias("at"), i["value"].alias("i"), d["value"].alias("d"), (i["sure"] & d["sure"]).alias("sure"))).alias("slots")).alias("hit"))
    # of an alignment: one row per window of the item that it meets and reading, so its set is bounded by the item
    aligned = _agreed(met.groupBy("key", "item", "offset").agg(F.collect_set("hit").alias("hits")).select("key", "item", "hits"))
    found = aligned.groupBy("key", "item").agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("matched"),
                                               F.max("changed").alias("changed_slots"))
    return found.join(sizes, "item").filter(F.col("matched") >= coverage * F.col("windows")).select(
        F.col("key").alias(key), F.col("item").alias(item), "windows", F.col("matched").cast("long"),
        (F.col("matched") / F.col("windows")).alias("coverage"), F.col("changed_slots").cast("long"))


def _widths(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """The lengths of templates that are shorter than a window."""
    rows = benchmark.filter(F.col(item).isNotNull()).select(whole(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = {n for t in batch.column(0).to_pylist() if 0 < (n := len(template(t)[0])) < WINDOW}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(some), pa.int32())], ["width"])
    return rows.mapInArrow(run, "width int").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Columns of ``op8``: one row per document and item that it holds."""
    return matches(docs, benchmark)


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns. Rows that share a key are told apart by their text."""
    mine = docs.withColumn("__llm_row", F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("")), F.xxhash64(whole(text))))
    gone = matches(mine, benchmark, "__llm_row", text).select(F.col("__llm_row").alias("gone")).distinct()
    return mine.join(gone, mine["__llm_row"] == gone["gone"], "left_anti").drop("__llm_row")
