"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score.

E-mail addresses, IP addresses, card numbers and international phone numbers are base spans: they stay, whatever their score. Bank
account numbers (mod-97), shorter card numbers (Luhn), social security numbers and national phone numbers are added where pattern,
checksum and context together reach ``ACCEPTED``. Every search is linear in the text, which is scanned once for digits, once each for
``@`` and ``+``, and once for the beginnings of account numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "short_card", "ssn", "local_phone")
KINDS = BASE + ADDED
#: Score that an added span must reach.
ACCEPTED = 0.6
#: Code points before and after a span in which words count as its context.
NEAR = 48

# Score of the pattern alone, and what a passed checksum adds.
PATTERN = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.4, "short_card": 0.2, "ssn": 0.3, "local_phone": 0.3}
CHECKED = {"card": 0.4, "iban": 0.45, "short_card": 0.2}
FOR, AGAINST = 0.35, -0.3

# Words that speak for a kind, in English, German, French and Spanish.
WORDS = {
    "email": "mail email e-mail contact correo courriel kontakt",
    "ip": "ip address host server adresse dirección servidor serveur",
    "card": "card credit visa mastercard amex debit karte kreditkarte carte tarjeta",
    "phone": "phone call tel telephone mobile cell fax whatsapp telefon handy anrufen téléphone appelez portable teléfono llame móvil",
    "iban": "iban account bank transfer konto überweisung compte virement cuenta transferencia",
    "ssn": "ssn social security",
}
WORDS["short_card"] = WORDS["card"]
WORDS["local_phone"] = WORDS["phone"]
# Words that speak against any kind.
OTHER = "isbn issn doi version order invoice tracking serial part model sku bestellung rechnung commande facture pedido factura"

# Length of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

# What follows an @; the name before it is found backwards, so that a long word without @ costs nothing.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Stretches that hold every IP address, card number and national phone number whole.
_NUMERIC = re.compile(r"[0-9][0-9 .()-]+")
# Groups of digits keep what they took: no shorter group could be followed by the next part.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"[0-9](?:[ .()-]{0,2}+[0-9])++")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


class Span(NamedTuple):
    """Code points ``start`` to ``end`` (exclusive) of a text."""

    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of the digits ends in zero."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, letters as 10 to 35 and its first four characters last, leaves 1 when divided by 97."""
    rest = 0
    for c in account[4:] + account[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that do not overlap; a name reaches back over all its characters, at most to the address before."""
    free = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > free and text[start - 1] in _NAME_CHARACTERS:
            start -= 1
        if start < found.start():
            yield start, found.end()
            free = found.end()


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    for found in _IBAN.finditer(text):
        start, part = found.start(), found.group()
        length = IBAN_LENGTHS.get(part[:2])
        if length is None or (start and text[start - 1].isalnum()):
            continue
        places = [k for k, c in enumerate(part) if c != " "]
        if len(places) < length:
            continue
        end = start + places[length - 1] + 1
        if end < len(text) and text[end].isalnum():
            continue
        if mod97(text[start:end].replace(" ", "")):
            yield start, end


def proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans (kind, start, end) that fit a pattern and pass the checks of its kind, before context is looked at."""
    for start, end in emails(text):
        yield "email", start, end
    for found in _PHONE.finditer(text):
        if 8 <= len(_digits(found.group())) <= 15:
            yield "phone", *found.span()
    for stretch in _NUMERIC.finditer(text):
        at, part = stretch.start(), stretch.group()
        if len(part) < 7:
            continue
        for found in _IP.finditer(part):
            values = [g.lstrip("0") or "0" for g in found.groups()]
            if all(len(v) <= 3 and int(v) <= 255 for v in values):
                yield "ip", at + found.start(), at + found.end()
        for found in _CARD.finditer(part):
            if 13 <= found.end() - found.start():
                digits = _digits(found.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    yield "card" if len(digits) >= 16 else "short_card", at + found.start(), at + found.end()
        for found in _SSN.finditer(part):
            yield "ssn", at + found.start(), at + found.end()
        for found in _LOCAL.finditer(part):
            if 7 <= found.end() - found.start() <= 45 and 7 <= len(_digits(found.group())) <= 15:
                yield "local_phone", at + found.start(), at + found.end()
    for start, end in _accounts(text):
        yield "iban", start, end


_WORDS = {kind: frozenset(words.split()) for kind, words in WORDS.items()}
_OTHER = frozenset(OTHER.split())


def score(text: str, kind: str, start: int, end: int) -> float:
    """Score from 0 to 1 of a span: its pattern, its checksum, and the words near it on the same text."""
    near = {w.lower() for w in _WORD.findall(text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR])}
    total = PATTERN[kind] + CHECKED.get(kind, 0.0) + FOR * bool(near & _WORDS[kind]) + AGAINST * bool(near & _OTHER)
    return round(min(max(total, 0.0), 1.0), 4)


def spans(text: str | None) -> list[Span]:
    """All spans by kind (in the order of ``KINDS``), then start; added ones overlap neither base spans nor each other. Null: none."""
    if not text:
        return []
    found = [Span(k, a, b, score(text, k, a, b), k in BASE) for k, a, b in proposed(text)]
    kept = [s for s in found if s.base]
    extra = [s for s in found if not s.base and s.score >= ACCEPTED]
    if extra:
        # By start, then the better one: a span is taken if it begins behind all that were taken, so one pass finds overlaps.
        taken = sorted((s.start, s.end) for s in kept)
        place, free = 0, 0
        for s in sorted(extra, key=lambda s: (s.start, -s.score, KINDS.index(s.kind))):
            while place < len(taken) and taken[place][0] < s.end:
                free = max(free, taken[place][1])
                place += 1
            if s.start >= free:
                kept.append(s)
                free = s.end
    return sorted(kept, key=lambda s: (KINDS.index(s.kind), s.start))


def masked(text: str | None) -> str | None:
    """The text with every stretch that spans cover replaced by the kind of its first span, such as ``[EMAIL]``."""
    out, at = [], 0
    for s in sorted(spans(text), key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return text if not out else "".join([*out, text[at:]])


def find(text: Column) -> Column:
    """Array of structs (kind, start, end, score, base) of a text column, in the order of ``spans``; empty for null and empty texts.

    Texts are read whole, each by itself, so repeated rows get equal results and other columns do not matter.
    """

    @F.arrow_udf("array<struct<kind: string, start: long, end: long, score: double, base: boolean>>")
    def apply(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
        return pa.array([[s._asdict() for s in spans(t)] for t in texts.to_pylist()], kind)

    return apply(text)


def mask(text: Column) -> Column:
    """A text column without the personal data that ``find`` finds; null stays null."""

    @F.arrow_udf("string")
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array(map(masked, texts.to_pylist()), pa.string())

    return apply(text)
