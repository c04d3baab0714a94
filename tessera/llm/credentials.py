"""Secret scan with multipart credential linking.

Base kinds (``assign``, ``access``, ``hex``) follow fixed patterns, leftmost and
non-overlapping per kind; matches failing their length are dropped without a
retry and the rest always stays.

A credential usually has several parts: an access identifier, a secret and the
endpoint they are good for. Each part alone may be too weak to report (a user
name, a random looking word, an address), so weak parts are only proposed:

1. proposals: names before ``:`` or ``=`` with their values, identifiers and
   opaque words by shape, addresses by ``://``; base spans are strong parts,
2. scopes: blocks of text between blank lines,
3. interval join: parts are put into the scope that contains them, and each part
   meets the nearest complementary part (identifier with secret, secret with
   identifier or endpoint) of its scope that is at most ``reach`` code points
   away. Parts of a role do not overlap, so a search in their order finds it:
   n log n in the parts of a document, never their pairs,
4. a weak part is reported if its score, raised by each complementary role met,
   reaches ``threshold``; without any it never does. Each secret with what it
   met is one credential.

All intervals of a scope lie in one text, so the join runs where the text is
and nothing is shuffled; a task holds one Arrow batch. Work is linear in the
text: names are read backwards from their sign over at most ``NAME`` characters.

Defined results: NULL and empty texts have no spans; positions are code points,
end exclusive; spans are ordered by start, then kind in the order of ``KINDS``;
repeated rows and NULL ids each get a row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow

BASE = ("assign", "access", "hex")
ROLES = ("identifier", "secret", "endpoint")
KINDS = BASE + ROLES
THRESHOLD = 0.5
#: Code points between two parts of one credential at most.
REACH = 240
#: Characters of a name before ``:`` or ``=`` that are read.
NAME = 48

# of ASCII letters only: a long s or a Kelvin sign is no letter of these names
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

_BLANK = re.compile(r"\n[\x20\t\r]*(?=\n)")
_SIGN = re.compile(r"[:=]")
_BEFORE = re.compile(r"""([A-Za-z][A-Za-z0-9_-]*)["']?\x20*\Z""")
_VALUE = re.compile(r"""\x20*["']?(?:[Bb]earer\x20+)?([^\s"'<>,;&]{3,}+)""")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_ADDRESS = re.compile(r"""://[^\s"'<>`]{3,}+""")
#: Name and password in an address.
_LOGIN = re.compile(r"://([^\s:/@]+):([^\s/@]+)@")
_SHAPED_ID = re.compile(r"(?<![A-Za-z0-9])(?:A(?:SIA|ROA|IDA)[A-Z0-9]{12,}+|AC[0-9a-f]{32}|"
                        r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})(?![A-Za-z0-9])")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
_DIGIT = re.compile(r"[0-9]")

#: Ends of a name (lower case, without ``-`` and ``_``) that tell its value's role.
NAMED = {
    "identifier": ("accesskeyid", "keyid", "clientid", "appid", "accountid", "accountsid", "tenantid", "userid", "username",
                   "user", "login"),
    "secret": ("password", "passwd", "passphrase", "pass", "pwd", "secret", "token", "apikey", "accesskey", "secretkey",
               "privatekey", "authkey", "signingkey", "authorization"),
    "endpoint": ("host", "hostname", "server", "endpoint", "url", "uri"),
}
_ROLE_OF = [(end, role) for role, ends in NAMED.items() for end in ends]
#: Score of a part by itself, named or by its shape, and for each complementary role met.
PRIOR = {("identifier", True): 0.35, ("identifier", False): 0.3, ("secret", True): 0.4, ("secret", False): 0.25,
         ("endpoint", True): 0.2, ("endpoint", False): 0.2}
STRONG = {"assign": 0.8, "access": 0.9, "hex": 0.7}
MEET = 0.3
COMPLEMENT = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}
_ROLE_OF_BASE = {"assign": "secret", "access": "identifier", "hex": "secret"}


class Part(NamedTuple):
    start: int
    end: int
    role: str
    kind: str       # a base kind, or the role of a weak part
    prior: float


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, each kind leftmost and non-overlapping."""
    found, low = [], text.lower()
    if any(name in low for name in _ASSIGN_NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], BASE.index(s[2])))


def entropy(s: str) -> float:
    """Bits per character."""
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _opaque(s: str) -> bool:
    """Letters and digits mixed, with the entropy of a random word."""
    return _DIGIT.search(s) is not None and any(c.isalpha() for c in s) and entropy(s) >= 3.5


def weak_parts(text: str) -> list[Part]:
    """Proposals by name and by shape, in no order."""
    out = []
    for m in _SIGN.finditer(text):
        name = _BEFORE.search(text, max(0, m.start() - NAME), m.start())
        if name is None or text.startswith("//", m.end()):
            continue
        said = name[1].lower().replace("_", "").replace("-", "")
        role = next((r for end, r in _ROLE_OF if said.endswith(end)), None)
        if role and (v := _VALUE.match(text, m.end())):
            out.append(Part(*v.span(1), role, role, PRIOR[role, True]))
    at = text.find("://")
    while at >= 0:
        scheme, rest = _SCHEME.search(text, max(0, at - NAME), at), _ADDRESS.match(text, at)
        if scheme and rest:
            out.append(Part(scheme.start(), rest.end(), "endpoint", "endpoint", PRIOR["endpoint", False]))
            if login := _LOGIN.match(text, at, rest.end()):
                out += [Part(*login.span(k), role, role, PRIOR[role, True]) for k, role in ((1, "identifier"), (2, "secret"))]
        at = text.find("://", rest.end() if rest else at + 3)
    out += [Part(*m.span(), "identifier", "identifier", PRIOR["identifier", False]) for m in _SHAPED_ID.finditer(text)]
    out += [Part(*m.span(), "secret", "secret", PRIOR["secret", False]) for m in _OPAQUE.finditer(text) if _opaque(m[0])]
    return out


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(starts, ends) of the union of intervals, disjoint and in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def overlaps(part: Part, cover: tuple[list[int], list[int]]) -> bool:
    i = bisect_left(cover[0], part.end)
    return i > 0 and cover[1][i - 1] > part.start


def parts_by_role(base: list[tuple[int, int, str]], weak: list[Part]) -> dict[str, list[Part]]:
    """Parts of each role in order and without overlaps. Base spans are strong
    parts and displace weak ones (an assignment and the digits in it are one
    secret); of weak parts the named comes first, then the earlier, the longer.
    A word inside an address is part of it, not a secret by its shape."""
    known = merged([(a, b) for a, b, _ in base])
    addresses = merged([p[:2] for p in weak if p.role == "endpoint"])
    out: dict[str, list[Part]] = {}
    for role in ROLES:
        kept: list[Part] = []
        strong = [Part(a, b, role, k, STRONG[k]) for a, b, k in base if _ROLE_OF_BASE[k] == role]
        shaped = PRIOR[role, False]
        proposed = [p for p in weak if p.role == role and (role == "endpoint" or not (
            overlaps(p, known) or role == "secret" and p.prior == shaped and overlaps(p, addresses)))]
        for p in sorted(strong + proposed, key=lambda p: (-p.prior, p.start, -p.end)):
            i = bisect_left(kept, p.end, key=lambda q: q.start)
            if not i or kept[i - 1].end <= p.start:
                kept.insert(i, p)
        out[role] = kept
    return out


def nearest(part: Part, others: list[Part], lo: int, hi: int, reach: int) -> Part | None:
    """The part of ``others`` within [lo, hi) at the smallest distance, at most
    ``reach``; the earlier of two."""
    i = bisect_right(others, part.start, key=lambda p: p.start)
    best = None
    for k in (i - 1, i):
        if 0 <= k < len(others) and lo <= others[k].start and others[k].end <= hi:
            gap = max(0, others[k].start - part.end, part.start - others[k].end)
            if gap <= reach and (best is None or gap < best[0]):
                best = (gap, others[k])
    return best and best[1]


def link(text: str | None, threshold: float = THRESHOLD, reach: int = REACH) -> tuple[list[tuple], list[tuple]]:
    """(spans, credentials): spans as (start, end, kind, score) in order;
    credentials as (identifier, secret, endpoint), each the number of a span or None."""
    text = text or ""
    base = base_spans(text)
    weak = weak_parts(text)
    scored: dict[Part, float] = {}
    groups = []
    if weak or len(base) > 1:
        roles = parts_by_role(base, weak)
        edges = [0, *[m.end() for m in _BLANK.finditer(text)], len(text)]
        for role in ROLES:
            for p in roles[role]:
                k = bisect_right(edges, p.start, hi=len(edges) - 1) - 1
                met = {r: nearest(p, roles[r], edges[k], edges[k + 1], reach) for r in COMPLEMENT[role]}
                found = sum(m is not None for m in met.values())
                scored[p] = min(1.0, round(p.prior + MEET * found, 2)) if found or p.kind in BASE else 0.0
                if role == "secret" and found:
                    groups.append((met["identifier"], p, met["endpoint"]))
    spans = [(a, b, k, STRONG[k]) for a, b, k in base]
    spans += [(p.start, p.end, p.kind, s) for p, s in scored.items() if p.kind not in BASE and s >= threshold]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    number = {s[:3]: i for i, s in enumerate(spans)}
    said = [tuple(p and number.get((p.start, p.end, p.kind)) for p in g) for g in groups]
    return spans, [g for g in said if sum(n is not None for n in g) > 1]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("score", pa.float64()), ("value", pa.string())]))
LINKS = pa.list_(pa.struct([(role, pa.int32()) for role in ROLES]))


def detect(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = THRESHOLD,
           reach: int = REACH) -> DataFrame:
    """(id, secrets, credentials): the spans of each row's whole text as structs
    (kind, start, end, score, value), and the credentials as structs of the
    0-based numbers of their spans (identifier, secret, endpoint)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            spans, links = [], []
            for text in b.column(1).to_pylist():
                found, groups = link(text, threshold, reach)
                spans.append([{"kind": k, "start": s, "end": e, "score": p, "value": text[s:e]} for s, e, k, p in found])
                links.append([dict(zip(ROLES, g, strict=True)) for g in groups])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPANS), pa.array(links, LINKS)],
                                             ["id", "secrets", "credentials"])

    out = map_arrow(df.select(F.col(id_col), F.col(text_col).cast("string")), run,
                    f"id {kind}, secrets array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>, "
                    "credentials array<struct<identifier:int,secret:int,endpoint:int>>")
    return out.withColumnRenamed("id", id_col)
