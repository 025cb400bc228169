"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds ``email``, ``ip``, ``card`` and ``phone`` by their fixed patterns are the base and always stay. The
method adds spans that overlap no base span and whose score, from checksum and context, is high enough:
account numbers (``iban``, mod-97), shorter card numbers (13 to 15 digits, Luhn) and telephone numbers
without a plus sign, both beside a word that names them.

Defined cases: a null text is an empty one and has no spans; a null doc_id stays null; repeated rows each
give their own row; whole texts are searched in time proportional to their length; columns other than
doc_id and text are not read. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import as_batch, map_texts, text_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")
#: A proposed span that isn't base stays with at least this score.
ACCEPTED = 0.7
#: Characters on either side in which a word counts as near.
NEAR = 40

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits that doesn't begin a match has none that begins inside it, so each run is tried once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
# fixed values: characters of an account number by country
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for country in countries.split()}
PLAIN_PHONE = re.compile(r"(?<![0-9+.])\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,4}(?![0-9])")
# fixed values: words that name a kind, in the languages of the corpus
WORDS = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|correo|courriel|kontakt)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|adresse|direcci[oó]n)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|kreditkarte|carte|tarjeta)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|telefon|handy|t[eé]l[eé]phone|tel[eé]fono|m[oó]vil)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b"),
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _ips(text: str):
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str, least: int, most: int):
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if least <= len(digits) <= most and luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _iban_end(text: str, start: int) -> int | None:
    """Where an account number that begins here ends: after its country's length, as the checksum says.

    Words in capitals and numbers that follow look like further groups. Where the length of a country isn't known, the
    last group's end that passes counts; where it is known, besides it only the end of all groups.
    """
    ends, code, at = [], "", start
    while len(code) < 34 and at < len(text):
        at += text[at] == " "
        if not ("0" <= text[at : at + 1] <= "9" or "A" <= text[at : at + 1] <= "Z"):
            break
        code, at = code + text[at], at + 1
        if len(code) >= 15 and not (text[at : at + 1].isascii() and text[at : at + 1].isalnum()):
            ends.insert(0, (len(code), at))
    known = IBAN_LENGTHS.get(code[:2])
    if known:
        ends = [e for e in ends if e[0] == known] + ends[:1]
    return next((end for n, end in ends if mod97(code[:n])), None)


def _ibans(text: str):
    m = IBAN_START.search(text)
    while m:
        end = _iban_end(text, m.start())
        if end:
            yield m.start(), end
        m = IBAN_START.search(text, end or m.end())


def _plain_phones(text: str):
    for m in PLAIN_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            yield m.span()


#: Score of a span before its context counts: how telling pattern and checksum are.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8}
UNSURE = {"card": 0.5, "phone": 0.4}
CONTEXT = 0.1
NAMED = 0.3


def _near(kind: str, text: str, start: int, end: int) -> bool:
    words = WORDS[kind]
    return bool(words.search(text[max(0, start - NEAR) : start]) or words.search(text[end : end + NEAR]))


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places that spans cover, as sorted stretches that don't overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _free(spans: Iterable[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The spans, given from left to right, that overlap no stretch taken: one walk along both."""
    at = 0
    for start, end in spans:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            yield start, end


def find(text: str) -> list[Span]:
    """All spans of a text, in the order of KINDS and then of their start."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    has_digit = re.search("[0-9]", text) is not None
    base = [("email", _emails(text))] if "@" in text else []
    if has_digit:
        base += [("ip", _ips(text)), ("card", _cards(text, 16, 19)), ("phone", _phones(text) if "+" in text else ())]
    for kind, spans in base:
        for start, end in spans:
            found[kind].append(Span(kind, start, end, PRIOR[kind] + CONTEXT * _near(kind, text, start, end)))
    if has_digit:
        taken = _merged((s.start, s.end) for spans in found.values() for s in spans)
        more = [("iban", PRIOR["iban"], CONTEXT, _ibans(text))]
        more += [("card", UNSURE["card"], NAMED, _cards(text, 13, 15)), ("phone", UNSURE["phone"], NAMED, _plain_phones(text))]
        for kind, prior, named, spans in more:
            made = []
            for start, end in _free(spans, taken):
                score = prior + named * _near(kind, text, start, end)
                if score >= ACCEPTED:
                    made.append(Span(kind, start, end, round(score, 2)))
            found[kind] += made
            taken = _merged([*taken, *((s.start, s.end) for s in made)])
    return [s for k in KINDS for s in sorted(found[k], key=lambda s: s.start)]


def base_spans(text: str) -> list[Span]:
    return [s for s in find(text) if is_base(s, text)]


def is_base(span: Span, text: str) -> bool:
    """Whether the fixed patterns alone give the span."""
    if span.kind == "card":
        return len(_digits(text[span.start : span.end])) >= 16
    return span.kind in BASE and (span.kind != "phone" or text[span.start] == "+")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap, their union."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def _written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def spans(docs: DataFrame) -> DataFrame:
    """One row per span: doc_id, kind, start, end, value and score."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
        ("value", pa.string()), ("score", pa.float64()),
    ])

    def run(batches):
        for ids, texts in text_batches(batches):
            rows = [
                (i, s.kind, s.start, s.end, t[s.start : s.end], s.score)
                for i, t in zip(ids.to_pylist(), texts) for s in find(t)
            ]
            yield as_batch(schema, [list(c) for c in zip(*rows)] or [[]] * 6)

    return map_texts(docs, run, "doc_id long, kind string, start long, end long, value string, score double")


def digests(docs: DataFrame) -> DataFrame:
    """Counts of base spans, a digest of them, and all spans with their scores, per document."""
    counts = [f"n_{k}" for k in BASE]
    schema = pa.schema([
        ("doc_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("base_sha256", pa.string()),
        ("spans", pa.string()), ("scores", pa.string()),
    ])

    def run(batches):
        for ids, texts in text_batches(batches):
            found = [find(t) for t in texts]
            base = [[s for s in spans if is_base(s, t)] for spans, t in zip(found, texts)]
            yield as_batch(schema, [
                ids,
                *[[sum(s.kind == k for s in b) for b in base] for k in BASE],
                [hashlib.sha256(_written(b).encode()).hexdigest() for b in base],
                [_written(f) for f in found],
                [",".join(f"{s.score:.2f}" for s in f) for f in found],
            ])

    text = ", ".join(f"{c} long" for c in counts)
    return map_texts(docs, run, f"doc_id long, {text}, base_sha256 string, spans string, scores string")


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind; texts without spans, and null texts, as they are."""

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t and redact(t, find(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
