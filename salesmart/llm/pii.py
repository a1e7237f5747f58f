"""Personal data: patterns propose, checksums confirm, context scores (operator 6). DataFrame functions only.

``regexp_extract_all`` gives a pattern's matches and ``split`` the text between them, so the lengths of
both, added up, are the matches' places (code points, end exclusive). The four base kinds are
kept whenever their check passes; the added kinds must also score ``THRESHOLD`` after the words before them
have raised or lowered the score. These are ``iban`` (mod 97), ``ssn``, and four of secrets: ``aws_key`` (its
characters' entropy), ``jwt`` (its header decodes to JSON that names an algorithm), ``private_key`` (a PEM block) and ``secret``, a value
that a word such as password or token is set to (entropy, and a digit in it; the span is the value alone).

The patterns are the contract's, written so that Java's matcher neither recurses nor goes back over a run of
characters: a run's start is found by looking behind, and repeats that nothing can follow are possessive.

Defined results: a null or empty text has no spans; every row gives one row, repeated rows too; whole texts
are searched; columns other than the named ones are not read. A text's spans are added up one by
one into an array, so time grows with the square of the matches in one text (10,000: below a second).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import whole

THRESHOLD = 0.5
WINDOW = 40               # characters before a span that are searched for context words
NOT_PRIVATE = r"\b(?:example|sample|version|order|invoice|ticket|serial|isbn)\b"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    may: str              # a text without this has no match
    score: float
    context: str
    base: bool = True
    group: int = 0        # the span is this group, at the match's end


#: The contract's kinds, in its order.
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOGIN = r"\b(?:login|auth|credentials?|config|env|export|access)\b"
_SET = r"""(?i)(?<![a-z0-9])(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|(?:secret|access)[_-]?key)["']?\s{0,2}[:=]\s{0,2}["']?"""
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8,
         r"\b(?:e-?mail|contact|write|mailto)\b"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"\b(?:ip|host|server|address|login)\b"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){12}", 0.8, r"\b(?:card|visa|credit|debit|payment)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, r"\b(?:phone|tel|call|mobile|fax|whatsapp)\b"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{11}", 0.8, r"\b(?:iban|account|bank|konto|compte|cuenta)\b", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3,
         r"\b(?:ssn|social security)\b", base=False),
    Kind("aws_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", "A[KS]IA[A-Z0-9]{16}", 0.8, _LOGIN, base=False),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", "eyJ", 0.8, _LOGIN, base=False),
    Kind("private_key", r"-----BEGIN (?:[A-Z0-9]++ ){0,3}PRIVATE KEY-----(?:[^-]++-----END (?:[A-Z0-9]++ ){0,3}PRIVATE KEY-----)?", "PRIVATE KEY-----",
         0.9, _LOGIN, base=False),
    Kind("secret", _SET + r"""([^\s"'<>,;:=][^\s"'<>,;]{7,}+)""", _SET, 0.8, _LOGIN, base=False, group=1),
)
SECRETS = ("aws_key", "jwt", "private_key", "secret")
MIN_ENTROPY = 2.5         # bits a character of a secret


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)

    def add(total: Column, k: Column) -> Column:      # k: place from the right, from 1
        d = F.substring(number, n - k + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(k % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without spaces leaves 1, its first four characters moved to the end."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest: Column, k: Column) -> Column:
        c = F.substring(turned, k, F.lit(1))
        return F.when(c >= "A", (rest * 100 + F.ascii(c) - 55) % 97).otherwise((rest * 10 + c.cast("int")) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def entropy(value: Column) -> Column:
    """Bits a character of a string that isn't empty, from how often its characters occur in it."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    n = F.size(chars)

    def bits(total: Column, c: Column) -> Column:
        share = F.size(F.filter(chars, lambda x: x == c)) / n
        return total - share * F.log2(share)
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), bits)


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(value)).between(13, 19), luhn(digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        compact = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(compact).between(15, 34), mod97(compact)).otherwise(F.lit(False))
    if kind == "ssn":
        return ~value.rlike("^(?:000|666|9[0-9]{2})-|-00-|-0000$")
    if kind == "aws_key":
        return entropy(value) >= MIN_ENTROPY
    if kind == "jwt":
        head = F.translate(F.substring_index(value, ".", 1), "-_", "+/")
        padded = F.rpad(head, ((F.length(head) + 3) / 4).cast("int") * 4, F.lit("="))
        return F.coalesce(F.get_json_object(F.try_to_binary(padded, F.lit("base64")).cast("string"), "$.alg").isNotNull(), F.lit(False))
    if kind == "secret":
        return value.rlike("[0-9]") & (entropy(value) >= MIN_ENTROPY)
    return F.lit(True)


def _placed(kind: Kind, text: Column) -> Column:
    """Confirmed matches with their places."""
    matches, gaps = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)
    both = F.zip_with(matches, gaps, lambda v, gap: F.struct(v.alias("v"), gap.alias("gap")))

    def add(done: Column, x: Column) -> Column:
        end = done["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["v"]), F.lit(0))
        value = F.regexp_extract(x["v"], kind.pattern, kind.group) if kind.group else x["v"]
        span = F.struct(F.lit(kind.name).alias("kind"), (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))
        some = F.when(x["v"].isNotNull() & confirmed(kind.name, value), F.concat(done["spans"], F.array(span)))
        return F.struct(end.alias("at"), some.otherwise(done["spans"]).alias("spans"))
    none = F.array().cast(SPAN)
    found = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("spans")), add)["spans"]
    may = F.contains(text, F.lit(kind.may)) if kind.may in ("@", "eyJ", "PRIVATE KEY-----") else text.rlike(kind.may)
    return F.when(may, found).otherwise(none)


def _scored(kind: Kind, text: Column, spans: Column) -> Column:
    def score(s: Column) -> Column:
        first = F.greatest(s["start"] - WINDOW, F.lit(0))
        near = F.lower(F.substring(text, first + 1, s["start"] - first))
        value = F.lit(kind.score) + F.when(near.rlike(kind.context), 0.3).otherwise(0.0) \
            - F.when(near.rlike(NOT_PRIVATE), 0.2).otherwise(0.0)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                        F.round(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)), 2).alias("score"))
    scored = F.transform(spans, score)
    return scored if kind.base else F.filter(scored, lambda s: s["score"] >= THRESHOLD)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans``: array of kind, start, end, value, score, by kind in the order of ``KINDS``, then start."""
    rows = docs.select(F.col(key), whole(text).alias("__text"))
    rows = rows.select(key, "__text", *(_placed(k, F.col("__text")).alias(f"__{k.name}") for k in KINDS))
    return rows.select(key, F.concat(*(_scored(k, F.col("__text"), F.col(f"__{k.name}")) for k in KINDS)).alias("spans"))


def pii_digests(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op6``; ``n_secret`` counts spans of the kinds of secrets, ``n_spans`` all spans."""
    found = find_pii(docs)
    base = [k.name for k in KINDS if k.base]
    place = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(name: str, *kinds: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"].isin(*kinds))).cast("long").alias(f"n_{name}")
    kept = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"].isin(*base)), place), ",")
    return found.select("doc_id", *(count(k, k) for k in base), F.sha2(kept.cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", place), ",").alias("spans"),
                        count("secret", *SECRETS), F.size("spans").cast("long").alias("n_spans"))
