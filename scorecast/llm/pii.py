"""Personal data in texts (built-in functions only).

Per kind a regular expression proposes spans, left to right without overlap;
validators confirm them (value ranges, digit counts, the Luhn checksum for
cards, mod-97 for IBANs), and words near a span raise its score. The base
kinds are email, ip, card and phone; the method adds IBANs and named secrets.
Positions are code points, end exclusive. They come from the pieces between
the matches: a match starts after all pieces and matches before it.

The patterns scan in one pass: quantifiers are possessive and a run of
characters is tried from its first character only, which finds the same
leftmost matches without trying every suffix of a long run.

Defined results
  * null or empty text: no span; dense matches in one long text are all found,
    in time that grows with their number;
  * null ids and repeated rows: one result row per input row; an empty table
    gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import free_name

LOCAL = "A-Za-z0-9._%+-"

# fixed patterns: each finds the leftmost non-overlapping matches of the plain
# form in its comment (matches that the validator drops anyway may be missing)
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+ of 16 digits or more
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # consumes the first four characters only and captures the longest candidate,
    # which may run into the next words; ``_iban`` looks for its end
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}))[A-Z]{2}[0-9]{2}",
    "secret": r"(?i)(?<![a-z0-9])(?:token|secret|password|api[_-]?key)\x20{0,2}[=:]\x20{0,2}[\x22']?[A-Za-z0-9+/_-]{16,}+",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "secret")

# fixed values: score without context, and the words that raise it by 0.25
SCORES = {"email": 0.7, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8, "secret": 0.6}
CONTEXT = {
    "email": ["mail", "contact", "write", "reply"],
    "ip": ["ip", "server", "host", "address", "login"],
    "card": ["card", "visa", "credit", "payment", "amex"],
    "phone": ["phone", "tel", "call", "mobile", "fax"],
    "iban": ["iban", "account", "bank", "transfer"],
    "secret": ["private", "credential", "auth", "access"],
}
CONTEXT_CHARS = 40
RUN = 128    # items of a scan between two noted states
SPAN = "struct<start:int,match:string>"
PIECE = 256  # characters of a piece of text, at least CONTEXT_CHARS

# fixed values: length of an IBAN -> country codes
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


@dataclass(frozen=True)
class Gate:
    """A cheap condition without which a pattern cannot match."""

    email: Column
    digits: Column

    def of(self, kind: str, text: Column) -> Column:
        if kind == "email":
            return self.email
        if kind == "phone":
            return self.digits & text.contains("+")
        if kind == "secret":
            return text.contains("=") | text.contains(":")
        return self.digits


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (capital letters and digits) leaves 1 modulo 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + c - 55) % 97).otherwise((acc * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.split(match, r"\.", -1)
        # leading zeros do not count; a part of more than three digits is over 255
        bare = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.substr(p, F.lit(1), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        d = _digits(match)
        return F.length(d).between(16, 19) & luhn(F.substr(d, F.lit(1), F.lit(19)))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _scan(items: Column, emitted: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Outputs of ``step(state, item) -> (state, output)``, with whole-number
    states from 0 and outputs of type ``emitted``.

    Spark copies an accumulator at every item. So a first pass carries the
    states alone and notes one per ``RUN`` items, a second one goes through
    each run from its noted state; no step copies the outputs so far.
    ``items`` must be a projected column, as lambdas read it.
    """
    def note(acc: Column, x: Column) -> Column:
        state, n = step(acc["state"], x)[0], acc["n"] + 1
        return F.struct(state.alias("state"), n.alias("n"),
                        F.when(n % RUN == 0, F.concat(acc["notes"], F.array(state))).otherwise(acc["notes"]).alias("notes"))

    def put(acc: Column, x: Column) -> Column:
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(out)).alias("out"))

    zero = F.lit(0)
    notes = F.aggregate(items, F.struct(zero.alias("state"), zero.alias("n"), F.array(zero).alias("notes")),
                        note, lambda acc: acc["notes"])
    return F.flatten(F.transform(notes, lambda state, run: F.aggregate(
        F.slice(items, run * RUN + 1, F.lit(RUN)),
        F.struct(state.alias("state"), F.array().cast(f"array<{emitted}>").alias("out")), put, lambda acc: acc["out"])))


def _cut_text(text: Column) -> Column:
    """The text in pieces of ``PIECE`` characters, so that a place in it is
    read without walking over all of the text before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0)


def _at(pieces: Column, start: Column, length: Column) -> Column:
    """``length`` (at most ``PIECE``) characters from code point ``start``."""
    i = F.floor(start / PIECE).cast("int")
    near = F.concat(F.coalesce(F.get(pieces, i), F.lit("")), F.coalesce(F.get(pieces, i + 1), F.lit("")))
    return F.substr(near, start - i * PIECE + 1, length)


def _iban_cut(pieces: Column, located: Column) -> Column:
    """Candidates cut at an end that mod-97 confirms.

    An end stands before a blank of the candidate, or is its last character
    with no letter or digit behind. The end that gives the country's length is
    taken first, else the longest; candidates without an end are dropped.
    """
    country = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for c in codes.split() for x in (c, n)])

    def cut(s: Column) -> Column:
        match = s["match"]
        last = F.length(match)
        closed = ~_at(pieces, s["start"] + last, F.lit(1)).rlike("[A-Za-z0-9]")

        def bare(e: Column) -> Column:
            return F.regexp_replace(F.substr(match, F.lit(1), e), " ", "")

        ends = F.filter(F.sequence(F.lit(15), last), lambda e: (
            ((e < last) & (F.substr(match, e + 1, F.lit(1)) == " ")) | ((e == last) & closed))
            & F.length(bare(e)).between(15, 34) & mod97(bare(e)))
        usual = F.try_element_at(country, F.substr(match, F.lit(1), F.lit(2)))
        best = F.array_max(F.transform(ends, lambda e: F.struct(
            F.coalesce(F.length(bare(e)) == usual, F.lit(False)).alias("usual"), e.alias("end"))))
        return F.struct(s["start"].alias("start"), F.substr(match, F.lit(1), best["end"]).alias("match"))

    return F.filter(F.transform(located, cut), lambda s: s["match"].isNotNull())


def _without_overlap(spans: Column) -> Column:
    """Left to right, spans that begin behind the last one taken."""
    def free(end: Column, s: Column) -> tuple[Column, Column]:
        ok = s["start"] >= end
        return F.when(ok, s["start"] + F.length(s["match"])).otherwise(end), F.when(ok, s)

    return F.filter(_scan(spans, SPAN, free), lambda s: s.isNotNull())


def _paired(found: Column, between: Column) -> Column:
    """array<struct<gap,match>>: every match with the length of the piece before it."""
    return F.zip_with(F.slice(between, 1, F.size(found)), found,
                      lambda a, b: F.struct(F.length(a).alias("gap"), b.alias("match")))


def _located(kind: str, pairs: Column) -> Column:
    """array<struct<start,match>>: a match starts after all pieces between the
    matches, and all matches, before it."""
    def place(pos: Column, x: Column) -> tuple[Column, Column]:
        start = pos + x["gap"]
        # the pattern of an iban consumes its first four characters only
        width = F.lit(4) if kind == "iban" else F.length(x["match"])
        return start + width, F.struct(start.alias("start"), x["match"].alias("match"))

    return _scan(pairs, SPAN, place)


def _spans(pieces: Column, kind: str, located: Column) -> Column:
    """array<struct<kind,start,end,score>> of the confirmed matches."""
    kept = _without_overlap(located) if kind == "iban" else F.filter(located, lambda s: confirmed(kind, s["match"]))

    def scored(s: Column) -> Column:
        start, end = s["start"], s["start"] + F.length(s["match"])
        lo = F.greatest(start - CONTEXT_CHARS, F.lit(0))
        near = F.lower(F.concat(_at(pieces, lo, start - lo), F.lit(" "), _at(pieces, end, F.lit(CONTEXT_CHARS))))
        raised = F.lit(False)
        for w in CONTEXT[kind]:
            raised = raised | near.contains(w)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                        (F.lit(SCORES[kind]) + F.when(raised, 0.25).otherwise(0.0)).alias("score"))

    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return F.when(F.size(located) > 0, F.transform(kept, scored)).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a column ``out``: array<struct<kind,start,end,score>> of
    all spans, by kind as listed and then by start. An input column of that
    name is replaced."""
    kinds = BASE + ADDED
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    t = free_name(docs.columns, "pii_text")
    m = {k: free_name(docs.columns, f"pii_m_{k}") for k in kinds}
    text = F.col(t)
    gate = Gate(text.contains("@"), text.rlike("[0-9]"))
    none = F.array().cast("array<string>")
    df = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias(t))
    df = df.select("*", *[F.when(gate.of(k, text), F.regexp_extract_all(text, F.lit(PATTERNS[k]), 1 if k == "iban" else 0))
                          .otherwise(none).alias(m[k]) for k in kinds])
    some = F.lit(False)
    for k in kinds:
        some = some | (F.size(m[k]) > 0)
    # projected before they are used, as an expression inside a lambda is computed
    # per element; the text goes on in one form only
    df = df.select(*[F.col(c) for c in keep], F.when(some, _cut_text(text)).otherwise(none).alias(t),
                   *[F.when(F.size(m[k]) > 0, _paired(F.col(m[k]), F.split(text, PATTERNS[k], -1))).alias(m[k]) for k in kinds])
    found = {k: _located(k, F.col(m[k])) for k in kinds}
    pieces = F.col(t)
    found["iban"] = _iban_cut(pieces, found["iban"])
    df = df.withColumns({m[k]: F.when(F.size(m[k]) > 0, found[k]) for k in kinds})
    spans = F.concat(*[_spans(pieces, k, F.col(m[k])) for k in kinds])
    return df.select(*[F.col(c) for c in keep], spans.alias(out))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
