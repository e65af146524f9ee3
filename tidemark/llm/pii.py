"""Personal data: patterns propose spans, validators confirm them, words nearby adjust scores.

Spans are in code points, the end exclusive. Base spans (e-mail addresses, IP addresses,
cards, phone numbers with a plus sign) are those of the patterns in ``BASE``: leftmost and
non-overlapping per kind; matches that fail their validator are dropped without retry.
They stay whatever their score. The method adds further candidates:

- cards inside longer chains of digits and cards of 13 to 15 digits, confirmed by Luhn,
- account numbers (IBAN) of their country's length, confirmed by mod-97,
- phone numbers without a plus sign, which nothing but the words nearby confirms.

A candidate starts with the weight of its pattern; a passed checksum and words of its kind
nearby raise it, words of other numbers lower it. It becomes a span from ``ACCEPT`` on, if
it overlaps no span chosen before it (base first, then by score, then by place).

Every scan is linear in the length of the text: runs are matched possessively and no start
inside a run is tried again. Cases: a null or empty text has no spans; every row gets its
own answer, whatever its id (null and repeated ids too); other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.tables import ship, text_or_empty, unused

KINDS = ("email", "ip", "card", "phone", "iban")
CHECKED, NEARBY, OTHER, ACCEPT = 0.4, 0.35, -0.3, 0.6
BEFORE, AFTER = 60, 30  # code points searched for context words

SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
_SPANS = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("score", pa.float64()),
            ("base", pa.bool_()),
        ]
    )
)

# Words that speak for a kind, and words of numbers that are nothing personal.
CONTEXT = {
    "email": "email e-mail mail mailto contact contacto kontakt courriel correo write",
    "ip": "ip ipv4 host server client address adresse dirección login remote gateway",
    "card": "card credit debit visa mastercard amex maestro payment carte tarjeta karte kreditkarte",
    "phone": "phone telephone tel call mobile cell fax whatsapp téléphone appelez teléfono móvil "
    "telefon handy anruf",
    "iban": "iban account bank bic swift konto compte cuenta überweisung virement",
}
OTHER_NUMBERS = "isbn issn doi order invoice tracking serial version release build part sku ticket"
# Length of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MT": 31, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TN": 24, "TR": 26, "UA": 29,
}

_CONTEXT = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
_OTHER = frozenset(OTHER_NUMBERS.split())
_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+|\d)?")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_RUN = re.compile(r"[0-9]+")
_GROUPED = [  # the usual groupings; a lookahead, so that places may overlap
    re.compile(rf"(?<![0-9])(?=({groups})(?![0-9]))")
    for groups in (
        "[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{1,3}",
        "[0-9]{4}(?:[ -][0-9]{4}){3}",
        "[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
    )
]
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_SIGNS = re.compile(r" ?([A-Z0-9])")
_PHONE = re.compile(
    r"(?<![0-9+(.-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])[0-9]{2,5}(?:[ .-][0-9]{2,5}){0,3}(?![0-9-])"
)


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float
    base: bool = False


def digits(text: str) -> str:
    return "".join(_RUN.findall(text))


def luhn(number: str) -> bool:
    """Whether the digits sum to a multiple of ten, every second from the right doubled."""
    total = 0
    for place, digit in enumerate(reversed(number)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether the account number, its first four signs last and letters as 10 to 35,
    leaves 1 on division by 97."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(sign, 36)) for sign in moved)) % 97 == 1


def is_ip(text: str) -> bool:
    parts = (part.lstrip("0") for part in text.split("."))
    return all(len(part) < 4 and int(part or 0) <= 255 for part in parts)


def is_card(text: str) -> bool:
    number = digits(text)
    return 16 <= len(number) <= 19 and luhn(number)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An ``@`` with a domain behind it takes the run of signs before it, down to the end
    of the address before."""
    low = 0
    for match in _DOMAIN.finditer(text):
        start = at = match.start()
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            low = match.end()
            yield start, low


def matches(pattern: re.Pattern, valid: Callable[[str], bool]) -> Callable:
    def found(text: str) -> Iterator[tuple[int, int]]:
        return (m.span() for m in pattern.finditer(text) if valid(m.group()))

    return found


# Kind, weight of the pattern, whether a validator confirms it, places.
BASE = (
    ("email", 0.6, False, emails),
    ("ip", 0.3, True, matches(_IP, is_ip)),
    ("card", 0.3, True, matches(_CHAIN, is_card)),
    ("phone", 0.6, False, matches(_PLUS, lambda text: 8 <= len(digits(text)) <= 15)),
)


def context(text: str, kind: str, start: int, end: int) -> float:
    """What the words around a place add to its score or take from it."""
    near = text[max(0, start - BEFORE) : start] + " | " + text[end : end + AFTER]
    words = set(_WORDS.findall(near.lower()))
    return NEARBY * bool(words & _CONTEXT[kind]) + OTHER * bool(words & _OTHER)


def cards(text: str) -> Iterator[tuple[float, bool, int, int]]:
    """Within chains that are no base card: runs of digits, and the usual groupings."""
    for chain in _CHAIN.finditer(text):
        if chain.end() - chain.start() < 13 or is_card(chain.group()):
            continue
        for run in _RUN.finditer(text, *chain.span()):
            if 13 <= len(run.group()) <= 19 and luhn(run.group()):
                yield (0.3 if len(run.group()) > 15 else 0.15), True, *run.span()
        for grouped in _GROUPED:
            for group in grouped.finditer(text, *chain.span()):
                if luhn(digits(group.group(1))):
                    yield 0.15, True, *group.span(1)


def ibans(text: str) -> Iterator[tuple[float, bool, int, int]]:
    """From every country and check digits on, as many signs as accounts there have."""
    for match in _IBAN.finditer(text):
        found, end = match.group(), match.end()
        length = IBAN_LENGTHS.get(found[:2], 0)
        while len(found) < length and (sign := _SIGNS.match(text, end)):
            found, end = found + sign.group(1), sign.end()
        whole = end == len(text) or not text[end].isalnum()
        if length and len(found) == length and whole and mod97(found):
            yield 0.3, True, match.start(), end


def phones(text: str) -> Iterator[tuple[float, bool, int, int]]:
    for match in _PHONE.finditer(text):
        if 7 <= len(digits(match.group())) <= 15:
            yield 0.3, False, *match.span()


ADDED = (("card", cards), ("phone", phones), ("iban", ibans))


def spans_of(text: str) -> list[Span]:
    """All spans of a text, by kind as listed, then by place."""
    chosen = [
        Span(kind, start, end, weight + CHECKED * checked + context(text, kind, start, end), True)
        for kind, weight, checked, find in BASE
        for start, end in find(text)
    ]
    more = [
        Span(kind, start, end, weight + CHECKED * checked + context(text, kind, start, end))
        for kind, find in ADDED
        for weight, checked, start, end in find(text)
    ]
    more = sorted((s for s in more if s.score >= ACCEPT), key=lambda s: (-s.score, s.start, s.end))
    if more:
        taken = bytearray(len(text))
        for span in chosen:
            taken[span.start : span.end] = b"\1" * (span.end - span.start)
        for span in more:
            if not any(taken[span.start : span.end]):
                taken[span.start : span.end] = b"\1" * (span.end - span.start)
                chosen.append(span)
    return sorted(chosen, key=lambda s: (KINDS.index(s.kind), s.start))


def _spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for text in batch:
            found = spans_of(text.as_py())
            out.append(
                [
                    {"kind": s.kind, "start": s.start, "end": s.end,
                     "score": min(1.0, max(0.0, s.score)), "base": s.base}
                    for s in found
                ]
            )
        yield pa.array(out, _SPANS)
    arrays.release()


def marked(documents: DataFrame, name: str = "spans") -> DataFrame:
    """``documents`` with a column ``name``: the spans of ``text``."""
    ship(documents.sparkSession)
    return documents.withColumn(name, F.arrow_udf(_spans, SPANS)(text_or_empty()))


def find(documents: DataFrame) -> DataFrame:
    """Per row: ``doc_id`` and its ``spans`` (kind, start, end, score, base)."""
    return marked(documents.select(F.col("doc_id").cast("long"), "text"))


def mask(documents: DataFrame) -> DataFrame:
    """``documents`` with every span of ``text`` replaced by its kind in angle brackets; of
    overlapping spans the first one names the whole. A null text stays null."""
    name = unused(documents, "_spans")

    @F.arrow_udf("string")
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            pieces, at = [], 0
            for span in sorted(found, key=lambda s: (s["start"], -s["end"])) if text else ():
                if span["start"] >= at:
                    pieces += [text[at : span["start"]], f"<{span['kind']}>"]
                at = max(at, span["end"])
            out.append(text and "".join(pieces) + text[at:])
        return pa.array(out, pa.string())

    found = marked(documents, name)
    text = masked(F.col("text").cast("string"), F.col(name))
    return found.select(
        *[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in documents.columns]
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans in their order, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
