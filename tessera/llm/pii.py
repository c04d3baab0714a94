"""Personal data: patterns propose, checksums confirm, context adjusts.

Base kinds (email, ip, card, phone) follow fixed patterns, leftmost and
non-overlapping per kind; matches failing their check are dropped without a
retry. Further kinds come from the same three steps: ``iban`` (pattern, then
mod-97 at each end it may have), ``ssn`` (pattern, then number ranges), ``id`` (digit strings that pass
Luhn next to a context word). Each span gets a score: its kind's prior, raised
by a passed checksum and by context words of the kind nearby, lowered by words
that point elsewhere. Base spans always stay; a further kind's span stays at
``threshold`` or more.

All patterns are linear in the text: an email grows left from its ``@``, and
repeats are possessive where that cannot change the match.

Defined results: NULL and empty texts have no spans; positions are code
points, end exclusive; spans are ordered by start, then kind in the order of
``KINDS``; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "id")
BASE = KINDS[:4]
THRESHOLD = 0.5
#: Code points looked at on either side of a span for context words.
CONTEXT = 40

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
# a match can only begin where a run of digits does: a later start in the run fails alike
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# a lookahead, so that an account number may begin inside what another start could read
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}))")
#: Characters of an account number by country.
IBAN_LENGTH = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "AE BG BH CR DE GB GE IE ME RS VA", 23: "GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in codes.split()}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_ID = re.compile(r"(?<![0-9A-Za-z])[0-9]{8,11}(?![0-9A-Za-z])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Score before context; words near a span that raise or lower it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "id": 0.2}
RAISE = {
    "email": ("mail", "email", "e-mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "adresse", "host", "server", "client"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "id": ("passport", "license", "licence", "id", "ausweis", "identity", "dni", "permis"),
}
LOWER = ("version", "isbn", "order", "invoice", "serial", "part", "figure", "section")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an account number: country and check digits moved to the
    end, letters as 10 to 35, remainder 1."""
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, ``@`` and a dotted
    domain. No class holds ``@``, so each ``@`` is tried once, with the run of
    local characters to its left."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        if m := _DOMAIN.match(text, at):
            # the run is read from a reversed slice that doubles until it ends
            size = 64
            while (run := len(_LOCAL.match(text[max(end, at - size):at][::-1])[0])) == size and at - size > end:
                size *= 2
            if run:
                found.append((at - run, m.end()))
                end = m.end()
        at = text.find("@", max(at + 1, end))
    return found


def ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping account numbers. Every end at a border of letters
    and digits is tried, the country's length first, then from the longest down."""
    found, last = [], 0
    for m in _IBAN.finditer(text):
        a, run = m.start(), m[1]
        if a < last:
            continue
        ends = []
        for k in range(15, len(run) + 1):
            after = text[a + k:a + k + 1]
            if run[k - 1] != " " and not (after.isascii() and after.isalnum()) and (n := k - run.count(" ", 0, k)) >= 15:
                ends.append((n != IBAN_LENGTH.get(run[:2]), -k))
        for _, k in sorted(ends):
            if mod97(run[:-k]):
                last = a - k
                found.append((a, last))
                break
    return found


def _digits(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def _proposals(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, kind, confirmed by a checksum or range)."""
    for a, b in emails(text):
        yield a, b, "email", False
    for m in _IP.finditer(text):
        if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in m[0].split(".")):
            yield m.start(), m.end(), "ip", False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.start(), m.end(), "card", True
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.start(), m.end(), "phone", False
    for a, b in ibans(text):
        yield a, b, "iban", True
    for m in _SSN.finditer(text):
        a, b, c = m[0].split("-")
        if a not in ("000", "666") and a < "900" and b != "00" and c != "0000":
            yield m.start(), m.end(), "ssn", False
    for m in _ID.finditer(text):
        if luhn(m[0]):
            yield m.start(), m.end(), "id", True


def score(text: str, start: int, end: int, kind: str, confirmed: bool) -> float:
    near = set(_WORD.findall((text[max(0, start - CONTEXT):start] + "\n" + text[end:end + CONTEXT]).lower()))
    s = PRIOR[kind] + 0.1 * confirmed + 0.35 * (not near.isdisjoint(RAISE[kind])) - 0.3 * (not near.isdisjoint(LOWER))
    return min(1.0, max(0.0, round(s, 2)))


def find_spans(text: str | None, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind as listed."""
    found = []
    for a, b, kind, confirmed in _proposals(text or ""):
        s = score(text, a, b, kind, confirmed)
        if kind in BASE or s >= threshold:
            found.append((a, b, kind, s))
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2]), f[1]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("score", pa.float64()), ("value", pa.string())]))


def detect(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           threshold: float = THRESHOLD) -> DataFrame:
    """(id, pii): all spans of each row's whole text as an array of structs
    (kind, start, end, score, value)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            spans = [[{"kind": k, "start": s, "end": e, "score": p, "value": t[s:e]}
                      for s, e, k, p in find_spans(t, threshold)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPANS)], ["id", "pii"])

    out = map_arrow(df.select(F.col(id_col), F.col(text_col).cast("string")), run,
                    f"id {kind}, pii array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>")
    return out.withColumnRenamed("id", id_col)


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each run of overlapping spans replaced by ``[KIND]`` of its first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
