"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Base kinds are email, ip, card and phone; their spans stay whatever their score
is. Further kinds are reported from a score of ``ACCEPT`` on: iban (mod-97 and
the country's length), short_card (13 to 15 digits that pass Luhn) and ssn
(digit groups 3-2-4). The score starts at a value of the kind, and a word of the
kind within ``REACH`` characters before or after the span raises it; a word that
tells of versions, orders and the like lowers it. Short cards and ssn reach
``ACCEPT`` only next to such a word.

Offsets count code points, ends are exclusive. Spans of one kind never overlap,
spans of different kinds may. Null texts are empty and have no spans. Repeated
rows get equal results, an empty table gives no rows, other columns play no
part. Every pattern runs in linear time: possessive repeats, and e-mail
addresses start from their ``@``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.llm.common import text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "ssn")
ACCEPT, REACH, NEAR = 0.6, 40, 0.3
#: Score of a confirmed span without context, by kind.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.8, "short_card": 0.4, "ssn": 0.4}
#: Context words by kind, and words that speak against personal data.
CONTEXT = {
    "email": ("mail", "contact", "contacto", "kontakt"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "short_card": ("card", "amex", "diners", "credit", "tarjeta", "karte", "carte"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
AGAINST = ("version", "order", "invoice", "isbn", "example", "page", "build")
#: IBAN lengths by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26, "UA": 29,
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_REST = {n: re.compile(r"(?:\x20?+[A-Z0-9]){%d}(?![^\W_])" % (n - 4)) for n in set(IBAN_LENGTHS.values())}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"\w+")

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the first four characters go to the end, letters count 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(text: str) -> str:
    return text.replace(" ", "").replace("-", "")


def _emails(t: str) -> Iterator[tuple[int, int]]:
    at, end = t.find("@"), 0
    while at >= 0:
        start = at
        while start > end and t[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(t, at + 1)):
            end = m.end()
            yield start, end
        at = t.find("@", max(at + 1, end))


def _ibans(t: str) -> Iterator[tuple[int, int]]:
    """Goes on at the end of a confirmed span, else at the next start; a country's length bounds each check."""
    at = 0
    while m := _IBAN.search(t, at):
        at = m.start() + 1
        rest = _IBAN_REST.get(IBAN_LENGTHS.get(m[0][:2]))
        if rest and (end := rest.match(t, m.end())) and mod97((m[0] + end[0]).replace(" ", "")):
            at = end.end()
            yield m.start(), at


def _found(t: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans by kind."""
    if "@" in t:
        for s, e in _emails(t):
            yield "email", s, e
    if not _DIGIT.search(t):
        return
    for m in _IP.finditer(t):
        if all(len(p) < 4 and int(p) < 256 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            yield "ip", *m.span()
    short = []
    for m in _CARD.finditer(t):
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            if len(d) > 15:
                yield "card", *m.span()
            else:
                short.append(m.span())
    for m in _PHONE.finditer(t):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield "phone", *m.span()
    for s, e in _ibans(t):
        yield "iban", s, e
    for s, e in short:
        yield "short_card", s, e
    for m in _SSN.finditer(t):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", *m.span()


def _score(t: str, kind: str, start: int, end: int) -> float:
    around = set(_WORD.findall(f"{t[max(0, start - REACH) : start]} {t[end : end + REACH]}".lower()))
    change = NEAR * (not around.isdisjoint(CONTEXT[kind])) - NEAR * (not around.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, SCORES[kind] + change)), 3)


def spans_of(text: str) -> list[Span]:
    """(kind, start, end, score), by kind in the order of ``KINDS``, then by start."""
    scored = [(k, s, e, _score(text, k, s, e)) for k, s, e in _found(text)]
    return [x for x in scored if x[0] in BASE or x[3] >= ACCEPT]


SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"


def _spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        found = [[{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in spans_of(t)] for t in f.text]
        yield pd.DataFrame({"doc_id": f.doc_id, "spans": found})


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and all its spans."""
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    found = rows.mapInPandas(_spans, f"doc_id string, spans {SPANS}")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[{}]") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind; of overlapping spans the first one counts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.text:
                parts, at = [], 0
                for k, s, e, _ in sorted(spans_of(t), key=lambda x: (x[1], -x[2])):
                    if s >= at:
                        parts += [t[at:s], mark.format(k)]
                        at = e
                out.append("".join([*parts, t[at:]]))
            yield pd.DataFrame({"doc_id": f.doc_id, "text": out})

    kind = docs.schema[key].dataType
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    return rows.mapInPandas(run, "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
