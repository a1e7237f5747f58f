"""Main text of web pages through wrappers of their hosts (operator 12).

A page's tags and texts become a union-free regular expression: elements that hold text, each text a slot ``#``,
neighbours that repeat (``li li li``, ``dt dd dt dd``) folded into a group ``+`` whose contents are aligned with each other. The
distinct expressions of a host are then aligned pair by pair: what both have stays, what one lacks becomes optional
``?``, a group that repeats in one repeats in both ``*``, texts that differ leave their slot open. The result is the host's wrapper, such as
``body(nav(ul(li(#)+)) article(h1(#) p(#)+) footer(#))``. Each slot carries what the host's pages hold there: pages, characters,
those in links, and whether it is the same text on every page.

Which slots hold the article is then decided on the wrapper. Elements that say what they are (menus, footers, asides, adverts,
forms, comments, by tag, role, class or id) are out. The article is the ``article`` element, else ``main``, else an element
named so; where nothing is named, template text (the same on ``SURE_PAGES`` pages or more) and slots that are mostly links are out too, and
the article is the innermost element that still holds nearly all the rest. Inside a named article nothing but the
former elements is dropped, however often its text recurs.

As Spark runs it: pages are parsed in place, a task sends each (host, expression) once for many pages, the figures of a slot are added
up by key, expressions are aligned in ``BUCKETS`` groups a host and then the groups' results, so neither a host with a third of all
pages nor one with very many layouts meets in one task as pages. The keep flags, one row a (host, expression), are a table
that joins back to the parsed pages; Spark broadcasts it only below its own threshold, and splits a hot key otherwise.

Defined results: a null html is empty; an empty page, or one without text, gives the empty text; a page without tags
is one block; a null or hostless url belongs to the host ``''``; every row gives one row, repeated rows and null keys too; nothing is
cut; texts below ``DEPTH`` nested blocks count to the block at that depth; an empty table gives no rows; columns other
than the named ones are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import shared, whole

DEPTH = 60                # nested blocks
WIDEST = 4                # neighbours that repeat as one group
BUCKETS = 64              # groups a host's expressions are aligned in first
HELD = 20_000             # expressions a task holds before it sends them
SURE_PAGES = 3            # with the same text before it counts as the template's
MOST = 0.8                # of the text an element has to hold to be stepped into
CELLS = 250_000           # of an alignment table; longer rows of children are aligned in step

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
UNSEEN = frozenset("audio button canvas datalist head noscript object select svg template video".split())
#: Start tags that end an open element of these names.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: Open elements beyond which a start tag ends nothing.
FENCE = frozenset("table ul ol dl menu".split())
NOISE_TAGS = frozenset("nav aside footer form dialog menu search fieldset".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent
    contentinfo cookie cookies copyright dialog disqus footer gdpr hidden login menu modal nav navbar navigation newsletter notice notices
    overlay pager pagination popup promo promotion recommended related replies reply respond rail search share sharing sidebar signup
    social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
HEADER_WORDS = frozenset("header masthead".split())
ARTICLE_WORDS = (frozenset({"article", "articlebody"}), frozenset({"main"}),
                 frozenset("content entry post story text maincontent postcontent".split()))

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[A-Za-z][^>]*>|</?[A-Za-z][^<>]*\Z""", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_NAMED = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_SIGN = re.compile(r"([a-z0-9.]*)\(|\)([?+*]?)|#([?+*]?)")


class Slot:
    """A text's place; ``of`` are the texts that it stands for."""

    __slots__ = ("of",)
    label = "#"

    def __init__(self, of: list):
        self.of = of


class Node:
    """An element, or with an empty name a group that repeats; ``items`` are [optional, repeated, slot or node]."""

    __slots__ = ("name", "items")

    def __init__(self, name: str, items: list):
        self.name, self.items = name, items

    @property
    def label(self) -> str:
        return self.name or "(" + " ".join(x[2].label for x in self.items) + ")"


def _mark(optional: bool, repeated: bool) -> str:
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def write(node: Node, slots: list[Slot]) -> str:
    """The expression of ``node``; its slots are added to ``slots`` in the order in which they are written."""
    parts = []
    for optional, repeated, x in node.items:
        if isinstance(x, Slot):
            slots.append(x)
        parts.append(("#" if isinstance(x, Slot) else write(x, slots)) + _mark(optional, repeated))
    return f"{node.name}({' '.join(parts)})"


def read(expression: str) -> tuple[Node, list[Slot]]:
    """The node that an expression stands for, and its slots."""
    top, slots = Node("", []), []
    stack = [top]
    for m in _SIGN.finditer(expression):
        name, end, slot = m.groups()
        if name is not None:
            node = Node(name, [])
            stack[-1].items.append([False, False, node])
            stack.append(node)
            continue
        if end is not None:
            stack.pop()
            item = stack[-1].items[-1]
        else:
            slots.append(Slot([len(slots)]))
            item = [False, False, slots[-1]]
            stack[-1].items.append(item)
        mark = end or slot
        item[0], item[1] = mark in ("?", "*"), mark in ("+", "*")
    return top.items[0][2], slots


def _merge(x, y):
    """Both contents, of equal labels, as one."""
    if isinstance(x, Slot):
        x.of += y.of
        return x
    x.items = align(x.items, y.items)
    return x


def _both(x: list, y: list) -> list:
    return [x[0] or y[0], x[1] or y[1], _merge(x[2], y[2])]


def align(x: list, y: list) -> list:
    """One row of items for two: a longest common row of labels is merged, the others become optional."""
    head = []
    k = 0
    while k < min(len(x), len(y)) and x[k][2].label == y[k][2].label:
        head.append(_both(x[k], y[k]))
        k += 1
    x, y = x[k:], y[k:]
    tail = []
    while x and y and x[-1][2].label == y[-1][2].label:
        tail.append(_both(x.pop(), y.pop()))
    if not x or not y:
        return head + [[True, r, c] for _, r, c in x or y] + tail[::-1]
    a, b = [i[2].label for i in x], [i[2].label for i in y]
    middle = []
    i = j = 0
    if len(a) * len(b) <= CELLS:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                middle.append(_both(x[i], y[j]))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                middle.append([True, *x[i][1:]])
                i += 1
            else:
                middle.append([True, *y[j][1:]])
                j += 1
    else:
        later = {}
        for k in range(len(b) - 1, -1, -1):
            later.setdefault(b[k], []).append(k)       # each label's places, the nearest last
        while i < len(a) and j < len(b):
            places = later.get(a[i], [])
            while places and places[-1] < j:
                places.pop()
            if places:
                middle += [[True, *y[k][1:]] for k in range(j, places[-1])]
                j = places[-1]
                middle.append(_both(x[i], y[j]))
                j += 1
            else:
                middle.append([True, *x[i][1:]])
            i += 1
    return head + middle + [[True, r, c] for _, r, c in x[i:] + y[j:]] + tail[::-1]


def fold(items: list) -> list:
    """Neighbours that repeat become groups."""
    labels = [x[2].label for x in items]
    out, i, n = [], 0, len(items)
    while i < n:
        for width in range(1, WIDEST + 1):
            unit = labels[i:i + width]
            k = i + width
            if unit == ["#"] or labels[k:k + width] != unit:
                continue
            group = items[i:k]
            while labels[k:k + width] == unit:
                group = [_both(x, y) for x, y in zip(group, items[k:k + width], strict=True)]
                k += width
            out.append([False, True, group[0][2] if width == 1 else Node("", group)])
            i = k
            break
        else:
            out.append(items[i])
            i += 1
    return out


def _words(attributes: str) -> list[str]:
    found = set()
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("hidden", "aria-hidden", "style"):
            if name == "hidden" or value == "true" or re.search(r"display\s*:\s*none", value):
                found.add("hidden")
        else:
            found.update(re.findall(r"[a-z]+", value))
    return sorted(found)


class _Builder:
    """A page's tree of blocks that hold text."""

    def __init__(self):
        self.top = Node("body", [])
        self.stack: list[tuple[str, Node | None, bool]] = []      # name, the block's node, whether its text isn't seen
        self.nodes = [self.top]
        self.texts: list[tuple[str, int]] = []
        self.held: list[tuple[str, bool]] = []
        self.unseen = self.links = 0

    def text(self, piece: str) -> None:
        if piece and not self.unseen:
            self.held.append((piece, self.links > 0))

    def flush(self) -> None:
        if not self.held:
            return
        if text := " ".join(_html.unescape("".join(p for p, _ in self.held)).split()):
            linked = len(" ".join(_html.unescape(" ".join(p for p, of in self.held if of)).split()))
            self.nodes[-1].items.append([False, False, Slot([len(self.texts)])])
            self.texts.append((text, min(linked, len(text))))
        self.held = []

    def pop(self) -> None:
        name, node, unseen = self.stack.pop()
        if node is not None:
            self.flush()
            self.nodes.pop()
            if node is not self.nodes[-1] and not node.items:
                self.nodes[-1].items.pop()       # it held no text
            elif node is not self.nodes[-1]:
                node.items = fold(node.items)
        self.unseen -= unseen
        self.links -= name == "a"

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            self.pop()

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text(" ")
        if name == "hr":
            self.flush()
        if name in VOID or name in ("html", "body"):
            if name == "body" and self.stack and self.stack[-1][0] == "head":
                self.pop()
            return
        if name not in BLOCKS:
            words = _words(attributes) if name in ("a", "span", "small", "label", "ins") and attributes else ()
            unseen = name in UNSEEN or not NOISE_WORDS.isdisjoint(words)
            if unseen or name == "a":
                self.stack.append((name, None, unseen))
                self.unseen += unseen
                self.links += name == "a"
            return
        self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in ("p", "head"):
                self.cut(k)
            elif self.stack[k][1] is not None:
                break
        if ends := ENDS.get(name):
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in ends:
                    self.cut(k)
                elif self.stack[k][0] in FENCE:
                    break
        node = self.nodes[-1]
        if len(self.nodes) < DEPTH:
            node = Node(".".join([name, *_words(attributes)]), [])
            self.nodes[-1].items.append([False, False, node])
        self.nodes.append(node)
        self.stack.append((name, node, False))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                if name in BLOCKS:
                    self.cut(k)
                else:
                    _, _, unseen = self.stack.pop(k)
                    self.unseen -= unseen
                    self.links -= name == "a"
                return


def parse(page: str) -> tuple[str, list[tuple[int, str, int]]]:
    """A page's expression, and its blocks in page order as slot, text and characters in links."""
    build, at = _Builder(), 0
    while m := _TOKEN.search(page, at):
        build.text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0][1] in "!?":
                continue
            m = _LOOSE.fullmatch(m[0])
            if m is None:      # a tag that the page's end cuts off
                continue
        name = m[2].lower()
        if m[1]:
            build.end(name)
        elif name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
        else:
            build.start(name, m[3])
    build.text(page[at:])
    build.cut(0)
    build.flush()
    build.top.items = fold(build.top.items)
    slots: list[Slot] = []
    expression = write(build.top, slots)
    of = {k: n for n, slot in enumerate(slots) for k in slot.of}
    return expression, [(of[k], text, linked) for k, (text, linked) in enumerate(build.texts)]


# ---------------------------------------------------------------------------------------------------------------------
# wrappers
# ---------------------------------------------------------------------------------------------------------------------

#: What a slot holds on a host's pages; ``low`` and ``high`` are the least and greatest hash of its text.
FIGURES = ("pages", "chars", "links", "low", "high")
_STAT = "struct<pages:bigint,chars:bigint,links:bigint,low:bigint,high:bigint>"


def _add(x: tuple, y: tuple) -> tuple:
    return (x[0] + y[0], x[1] + y[1], x[2] + y[2], min(x[3], y[3]), max(x[4], y[4]))


def combine(expressions: list[tuple[str, list[tuple]]]) -> tuple[str, list[tuple], list[list[int]]]:
    """Expressions with their slots' figures aligned one after the other, in the order of their text, so the result doesn't
    depend on how rows arrive: the wrapper, its slots' figures, and for each expression the wrapper's slot of each of its own."""
    order = sorted(range(len(expressions)), key=lambda k: expressions[k][0])
    merged = None
    for k in order:
        node, slots = read(expressions[k][0])
        for slot in slots:
            slot.of = [(k, slot.of[0])]
        merged = node if merged is None else _merge(merged, node)
    slots: list[Slot] = []
    wrapper = write(merged, slots)
    maps = [[0] * len(stats) for _, stats in expressions]
    figures = []
    for n, slot in enumerate(slots):
        total = None
        for k, own in slot.of:
            maps[k][own] = n
            total = expressions[k][1][own] if total is None else _add(total, expressions[k][1][own])
        figures.append(total)
    return wrapper, figures, maps


class _Place:
    """An element of a wrapper, for a page that fills the slots ``own`` below it."""

    def __init__(self, node: Node, path: list[_Place], own: set[int], counter: list[int]):
        tag, *words = node.name.split(".")
        self.tag, self.words, self.path = tag, set(words), path
        self.slots: list[int] = []
        self.below: list[_Place] = []
        self.all: list[int] = []
        for _, _, x in node.items:
            if isinstance(x, Slot):
                if counter[0] in own:
                    self.slots.append(counter[0])
                    self.all.append(counter[0])
                counter[0] += 1
            else:
                place = _Place(x, [*path, self], own, counter)
                self.all += place.all
                if place.all:
                    self.below.append(place)

    def walk(self) -> Iterator[_Place]:
        yield self
        for place in self.below:
            yield from place.walk()

    def holds(self, *tags: str) -> bool:
        return any(p.tag in tags for p in self.walk() if p is not self)

    def noise(self, header: bool) -> bool:
        """Whether the element says that it is none of the article; ``header``: headers too."""
        if self.tag in NOISE_TAGS or header and self.tag == "header":
            return not self.holds("article", "main")
        words = NOISE_WORDS | HEADER_WORDS if header else NOISE_WORDS
        return self.path != [] and not words.isdisjoint(self.words) and not self.holds("article", "main", "h1")


def decide(wrapper: str, figures: list[tuple], own: set[int]) -> set[int]:
    """The wrapper's slots that hold the article, for pages that fill the slots ``own``."""
    top = _Place(read(wrapper)[0], [], own, [0])

    def clean(place: _Place, header: bool, out: list[int]) -> list[int]:
        """Slots below ``place`` that aren't in noise."""
        out += place.slots
        for p in place.below:
            if not p.noise(header):
                clean(p, header, out)
        return out

    def seen(place: _Place) -> Iterator[_Place]:
        yield place
        for p in place.below:
            if not p.noise(True):
                yield from seen(p)
    plain = lambda slots: sum(figures[s][1] - figures[s][2] for s in slots)
    places = list(seen(top))
    named = [[p for p in places if p.tag == "article"], [p for p in places if p.words & ARTICLE_WORDS[0]],
             [p for p in places if p.tag == "main" or p.words & ARTICLE_WORDS[1]], [p for p in places if p.words & ARTICLE_WORDS[2] and p.path]]
    for group in named:
        best = max(group, key=lambda p: plain(clean(p, False, [])), default=None)
        if best is not None and (kept := clean(best, False, [])):
            return set(kept)

    def useful(slots: list[int]) -> list[int]:
        return [s for s in slots if 2 * figures[s][2] < figures[s][1] and not (figures[s][0] >= SURE_PAGES and figures[s][3] == figures[s][4])]
    rest = useful(clean(top, True, []))
    titles = [s for p in places if p.tag == "h1" for s in p.all if s in set(rest)]
    place, whole_text = top, plain(rest)
    while True:
        inner = [p for p in place.below if not p.noise(True) and p.below
                 and plain(useful(clean(p, True, []))) >= MOST * whole_text > 0]
        if not inner:
            return set(useful(clean(place, True, []))) | set(titles)
        place = inner[0]


# ---------------------------------------------------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """The host that a url names, in lower case; '' if none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _page_rows(pages: DataFrame, *more: str, url: str, html: str) -> DataFrame:
    return pages.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(more)),
                        host_of(F.col(f"`{url}`").cast("string")).alias("host"), whole(F.col(f"`{html}`").cast("string")).alias("html"))


_SEEN = "host string, expression string, stats array<" + _STAT + ">"
_STRUCT = pa.list_(pa.struct([(c, pa.int64()) for c in FIGURES]))


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each host's expressions with their slots' figures, once for many pages."""
    held: dict[tuple[str, str], list[tuple]] = {}

    def batch() -> pa.RecordBatch:
        stats = [[dict(zip(FIGURES, s, strict=True)) for s in v] for v in held.values()]
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()),
                                           pa.array(stats, _STRUCT)], ["host", "expression", "stats"])
    for rows in batches:
        for host, page in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            expression, blocks = parse(page)
            own: dict[int, list] = {}
            for slot, text, linked in blocks:
                x = own.setdefault(slot, [0, 0, []])
                x[0] += len(text)
                x[1] += linked
                x[2].append(text)
            stats = []
            for slot in range(len(own)):
                chars, linked, texts = own[slot]
                h = xxhash.xxh64_intdigest("\n".join(texts)) - (1 << 63)
                stats.append((1, chars, linked, h, h))
            key = host, expression
            before = held.get(key)
            held[key] = stats if before is None else list(map(_add, before, stats))
        if len(held) > HELD:
            yield batch()
            held = {}
    if held:
        yield batch()


def _stats(rows) -> list[tuple]:
    return [tuple(r[c] for c in FIGURES) for r in rows]


def _structs(figures: list[tuple]) -> list[dict]:
    return [dict(zip(FIGURES, f, strict=True)) for f in figures]


def _align_expressions(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's expressions as one: a row for each with its slots' places, and one for the result."""
    found = [(e, _stats(s)) for e, s in zip(rows["expression"], rows["stats"], strict=True)]
    part, figures, maps = combine(found)
    host, bucket = rows["host"].iloc[0], int(rows["bucket"].iloc[0])
    out = [(host, bucket, e, None, m, None) for (e, _), m in zip(found, maps, strict=True)]
    return pd.DataFrame([*out, (host, bucket, None, part, None, _structs(figures))],
                        columns=["host", "bucket", "expression", "part", "places", "stats"])


def _align_parts(rows: pd.DataFrame) -> pd.DataFrame:
    """A host's wrapper, for each of its buckets with the bucket's slots' places."""
    found = [(e, _stats(s)) for e, s in zip(rows["part"], rows["stats"], strict=True)]
    wrapper, figures, maps = combine(found)
    return pd.DataFrame([(h, int(b), wrapper, m, _structs(figures)) for h, b, m in zip(rows["host"], rows["bucket"], maps, strict=True)],
                        columns=["host", "of_bucket", "wrapper", "places_of_bucket", "figures"])


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        keep = []
        for r in rows:
            at = [r["places_of_bucket"][p] for p in r["places"]]
            kept = decide(r["wrapper"], _stats(r["figures"]), set(at))
            keep.append([p in kept for p in at])
        yield pa.RecordBatch.from_arrays([pa.array([r["host"] for r in rows], pa.string()), pa.array([r["expression"] for r in rows], pa.string()),
                                          pa.array(keep, pa.list_(pa.bool_()))], ["host", "expression", "keep"])


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """``host, wrapper, figures`` of every host, and ``host, expression, keep``: which slots of a page's expression
    hold its article."""
    seen = _page_rows(pages, url=url, html=html).mapInArrow(_seen, _SEEN)
    slots = seen.select("host", "expression", F.posexplode("stats").alias("slot", "s")).groupBy("host", "expression", "slot").agg(
        *(F.sum(f"s.{c}").alias(c) for c in FIGURES[:3]), F.min("s.low").alias("low"), F.max("s.high").alias("high"))
    stats = F.transform(F.array_sort(F.collect_list(F.struct("slot", *FIGURES))), lambda x: F.struct(*(x[c].alias(c) for c in FIGURES)))
    known = slots.groupBy("host", "expression").agg(stats.alias("stats"))        # an expression has few slots
    known = known.withColumn("bucket", F.pmod(F.xxhash64("expression"), F.lit(BUCKETS)).cast("int"))
    first = shared(known.groupBy("host", "bucket").applyInPandas(
        _align_expressions, f"host string, bucket int, expression string, part string, places array<int>, stats array<{_STAT}>"), "parts")
    second = shared(first.filter("part IS NOT NULL").groupBy("host").applyInPandas(
        _align_parts, f"host string, of_bucket int, wrapper string, places_of_bucket array<int>, figures array<{_STAT}>"), "wrappers")
    both = first.filter("expression IS NOT NULL").select("host", "bucket", "expression", "places").join(
        second.withColumnRenamed("of_bucket", "bucket"), ["host", "bucket"])
    keep = shared(both.select("host", "expression", "places", "wrapper", "places_of_bucket", "figures")
                  .mapInArrow(_decided, "host string, expression string, keep array<boolean>"), "keep")
    return second.select("host", "wrapper", "figures").dropDuplicates(["host"]), keep


def _blocks(key_type: str, url_type: str):
    schema = f"page_key {key_type}, page_url {url_type}, host string, expression string, blocks array<struct<slot:int,text:string>>"
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(page) for page in batch.column(3).to_pylist()]
            blocks = [[{"slot": slot, "text": text} for slot, text, _ in b] for _, b in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([e for e, _ in found], pa.string()), pa.array(blocks, kind)],
                                             ["page_key", "page_url", "host", "expression", "blocks"])
    return run, schema


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key, url, text``: the article's blocks of every page, in page order, a line each."""
    _, keep = infer(pages, url, html)
    run, schema = _blocks(pages.schema[key].dataType.simpleString(), pages.schema[url].dataType.simpleString())
    rows = _page_rows(pages, key, url, url=url, html=html).mapInArrow(run, schema)
    kept = F.filter("blocks", lambda b: F.get("keep", b["slot"]))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return rows.join(keep, ["host", "expression"], "left").select(
        F.col("page_key").alias(key), F.col("page_url").alias(url), F.coalesce(text, F.lit("")).alias("text"))


def extract(pages: DataFrame) -> DataFrame:
    """Contract columns of ``op12``."""
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
