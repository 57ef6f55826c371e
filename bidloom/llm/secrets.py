"""Secrets in texts: fixed key patterns, and an assignment-aware lexer that scores literals by the names they are assigned to."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import small

# The base patterns. Each has a least length, of group 2 or else of the match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Kinds in the order in which spans with equal starts are listed.
KINDS = ("assign", "access", "hex", "literal")

_ASSIGN_WORD = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
#: Maximal runs of hex digits that are long enough, without stopping at each shorter run.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    found = []
    if _ASSIGN_WORD.search(text):
        found += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [Span("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return found


#: An assignment: a name (also quoted or dotted), an operator, then the place where its value begins.
_TARGET = re.compile(r"""(?<![\w.-])["']?(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)["']?[\x20\t]*(?::=|=>|(?P<more>\+=)|\??=(?!=)|:(?![:/]))[\x20\t]*(?=\S)""")
#: Literals in three, two or one quotes, with the prefixes that languages know. The group that took part is the content.
_QUOTED = re.compile(
    r"[bBrRuUfFL@]{0,2}(?:"
    r'"""((?:[^"\\]|\\.|"(?!""))*+)"""|' r"'''((?:[^'\\]|\\.|'(?!''))*+)'''|"
    r"\"((?:[^\"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`)", re.DOTALL)
#: An unquoted value. It ends before the next pair of a query string.
_BARE = re.compile(r"(?:[A-Za-z0-9+/_.=$@!%^*~-]|&(?![A-Za-z_][A-Za-z0-9_.-]*+=))+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
#: A name as shells and templates write it: $NAME, ${NAME}, {{ NAME }}.
_REFERENCE = re.compile(r"\$([A-Za-z_][A-Za-z0-9_]*+)|\$\{([A-Za-z_][A-Za-z0-9_]*+)\}|\{\{\x20*+([A-Za-z_][A-Za-z0-9_.]*+)\x20*+\}\}")
_OPEN = re.compile(r"\([\s(]*+")
_PLUS = re.compile(r"[\x20\t]*\+[\x20\t]*")
_INSIDE_PLUS = re.compile(r"\s*+\+\s*+")
_BESIDE = re.compile(r"[\x20\t]*+(?:\\\n[\x20\t]*+)?(?=[bBrRuUfFL@]{0,2}[\"'])")
_INSIDE_BESIDE = re.compile(r"\s*+(?=[bBrRuUfFL@]{0,2}[\"'])")
#: An XML element without elements inside.
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*+)(?:\s[^<>]*+)?>([^<>]++)</([A-Za-z_][A-Za-z0-9_.:-]*+)\s*+>")
_NAME_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-"

#: Weight of the parts of a target's name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "auth": 0.6, "bearer": 0.7, "private": 0.5, "access": 0.4, "key": 0.5, "salt": 0.5, "signature": 0.4}
#: Parts that say the value is about a secret but is none.
HARMLESS = {"length", "len", "count", "type", "name", "file", "path", "url", "field", "label", "policy", "id", "hint", "limit", "max", "min"}
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_PLACEHOLDER = re.compile(r"^(?:x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|(?:your|my|the|some|an?)[_-].*|change_?me.*|example.*|placeholder.*|none|null|true|false|todo|redacted)$", re.IGNORECASE)
#: A literal is reported from this score on.
THRESHOLD = 0.5
_ANY_SENSITIVE = re.compile("|".join(sorted(SENSITIVE, key=len, reverse=True)), re.IGNORECASE | re.ASCII)


def name_weight(name: str) -> float:
    """How much a target's name speaks for a secret, 0 to 1: its strongest part, more if two parts agree (api key, access token)."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if any(p in HARMLESS for p in parts[-1:]):
        return 0.0
    weights = sorted((SENSITIVE.get(p, 0.0) for p in parts), reverse=True)[:2]
    if "api" in parts and "key" in parts or "private" in parts and "key" in parts:
        return 1.0
    return min(1.0, sum(weights)) if weights else 0.0


#: Signs kept from both ends of a value; placeholders show there, or in the set of all signs.
ENDS = 32


class Value:
    """What scoring needs of a value, which adds up exactly however long sums of values get: length, counts of signs, both ends, and
    the places of its literals as a tree whose parts are shared."""

    __slots__ = ("length", "counts", "head", "tail", "places", "parts")

    def __init__(self, literal: str = "", place: tuple[int, int] | None = None):
        self.length, self.counts = len(literal), Counter(literal)
        self.head, self.tail = literal[:2 * ENDS], literal[-ENDS:]
        self.places, self.parts = [place] if place else [], []

    def __add__(self, other: Value) -> Value:
        if not other.length:
            return self
        if not self.length:
            return other
        out = Value()
        out.length, out.counts = self.length + other.length, self.counts.copy()
        for sign, n in other.counts.items():
            out.counts[sign] += n
        out.head = self.head if self.length >= 2 * ENDS else (self.head + other.head)[:2 * ENDS]
        out.tail = (self.tail + other.tail)[-ENDS:]
        out.parts = [self, other]
        return out

    def outline(self) -> str:
        """The value, or if it is long, a shorter one that is a placeholder exactly if the value is."""
        return self.head if self.length <= 2 * ENDS else self.head[:ENDS] + "".join(self.counts) + self.tail


def literal_weight(value: Value) -> float:
    """How much a value looks like a secret, 0 to 1: length, entropy and mixed character classes; placeholders count 0."""
    n, signs = value.length, "".join(value.counts)
    if n < 8 or any(c.isspace() for c in signs) or _PLACEHOLDER.match(value.outline()):
        return 0.0
    entropy = -sum(p * math.log2(p) for k in value.counts.values() if (p := k / n))
    classes = sum(bool(re.search(p, signs)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 3.5) * min(1.0, 0.4 + 0.3 * (classes - 1) + 0.02 * min(n - 8, 100))


class Binding(NamedTuple):
    name: str
    value: Value


def bindings(text: str) -> list[Binding]:
    """Name-literal pairs: quoted literals, bare values, sums and rows of literals and names, names bound earlier; then XML elements.

    A name that is bound again to something without a literal stands for no constant from there on; `+=` adds to what it stands for.
    """
    known: dict[str, Value] = {}
    out, at = [], 0
    while m := _TARGET.search(text, at):
        value, at = _expression(text, m.end(), known)
        if m["more"] and value.length:
            value = known.get(m["name"], Value()) + value
        if value.length:
            out.append(Binding(m["name"], value))
            known[m["name"]] = value
        elif not m["more"]:
            known.pop(m["name"], None)
    for m in _ELEMENT.finditer(text):
        literal = m[2].strip()
        if literal and m[1] == m[3]:
            start = m.start(2) + len(m[2]) - len(m[2].lstrip())
            out.append(Binding(m[1].rpartition(":")[2], Value(literal, (start, start + len(literal)))))
    return out


def _referred(m: re.Match | None, known: dict[str, Value]) -> Value | None:
    return known.get(m[m.lastindex]) if m else None


def _expression(text: str, at: int, known: dict[str, Value]) -> tuple[Value, int]:
    """The value that begins at `at`, and where to look for the next assignment: in what was read, as literals may hold assignments
    themselves, but behind a bare value, of which only a name at its end can be the next target."""
    value, first, begin = Value(), True, at
    opened = _OPEN.match(text, at)
    plus, beside = (_INSIDE_PLUS, _INSIDE_BESIDE) if opened else (_PLUS, _BESIDE)
    at = opened.end() if opened else at
    while True:
        quoted = False
        if (m := _QUOTED.match(text, at)):
            group, quoted = m.lastindex, True
            constant = _referred(_REFERENCE.fullmatch(text, *m.span(group)), known)
            value += constant if constant is not None else Value(m[group], m.span(group))
        elif (m := _NAME.match(text, at)) and m[0] in known and not _BARE.match(text, m.end()):
            value += known[m[0]]
        elif (constant := _referred(m := _REFERENCE.match(text, at), known)) is not None and not _BARE.match(text, m.end()):
            value += constant
        elif first and (m := _BARE.match(text, at)):  # configuration files leave values unquoted
            literal = m[0].rstrip(".")
            return Value(literal, (at, at + len(literal))), at + len(m[0].rstrip("=").rstrip(_NAME_SIGNS))
        else:
            return value, begin
        more = plus.match(text, m.end()) or (beside.match(text, m.end()) if quoted else None)
        if not more:
            return value, begin
        at, first = more.end(), False


def literal_spans(text: str) -> list[Span]:
    """Literals whose value, under the name it ends up with, scores as a secret."""
    if not _ANY_SENSITIVE.search(text):
        return []
    found, listed = set(), set()
    for b in bindings(text):
        weight = name_weight(b.name)
        if weight and weight * literal_weight(b.value) >= THRESHOLD:
            waiting = [b.value]
            while waiting:  # parts that an earlier value has listed are not opened again
                part = waiting.pop()
                if id(part) not in listed:
                    listed.add(id(part))
                    found.update(Span("literal", a, z) for a, z in part.places)
                    waiting += part.parts
    return sorted(found)


def find_spans(text: str) -> list[Span]:
    base = base_spans(text)
    starts = sorted(s.start for s in base)
    reach = list(accumulate((s.end for s in sorted(base, key=lambda s: s.start)), max))
    inside = lambda s: (k := bisect_right(starts, s.start)) > 0 and s.end <= reach[k - 1]
    added = [s for s in literal_spans(text) if not inside(s)]
    return sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind)))


def digest(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redacted(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by `mask`."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s.start):
        if s.start >= at:
            out += [text[at:s.start], mask]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        spans = [find_spans(t) for t in texts]
        base = [[s for s in row if s.kind != "literal"] for row in spans]
        count = lambda kind: pa.array([sum(s.kind == kind for s in row) for row in base], pa.int64())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
            "base_sha256": pa.array([hashlib.sha256(digest(b).encode()).hexdigest() for b in base], pa.string()),
            "spans": pa.array(list(map(digest, spans)), pa.string())})


def secret_spans(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of `documents(doc_id, text)`.

    `spans` lists kind:start:end in code points (end exclusive), by start and kind. Null texts count as empty: no spans, the digest of
    the empty text. Null and repeated ids keep a row each; other columns are ignored; an empty table gives an empty result; texts
    are scanned whole.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        texts = [t if t is None else redacted(t, find_spans(t)) for t in batch.column("text").to_pylist()]
        columns = dict(zip(batch.schema.names, batch.columns))
        yield pa.RecordBatch.from_pydict(columns | {"text": pa.array(texts, pa.string())})


def redact(documents: DataFrame) -> DataFrame:
    """The same rows and columns with every secret in `text` replaced by a mark; null texts stay null."""
    return documents.mapInArrow(_mask, documents.schema)
