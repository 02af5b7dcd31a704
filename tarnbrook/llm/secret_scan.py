"""Secret scan: fixed patterns plus assignment-aware lexing.

Base kinds are the patterns below, leftmost and non-overlapping within a kind. The
lexer goes from assignment sign to assignment sign: it reads the name before the
sign (``name``, ``"name"``, ``a.b.name``) and the literals after it (quoted, joined
by ``+``, or a bare configuration value that ends its line), remembers what each
name was bound to, and follows bare names to the literals bound earlier (constant
propagation). A literal is scored by the words of its target name and by how
random it looks; those that pass become spans of kind ``lexed``, at the literal
itself. A literal that lies in a base span of the same text is not added again.

Texts are scanned whole, in time that grows with their length. A null text is an
empty one. Repeated rows are scanned each on their own, an empty table gives an empty
result. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns, the smallest length of what counts, and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "lexed")
BASE_KINDS = KINDS[:3]

ASSIGN_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Words of a target name and what they add to a literal's score.
NAME_SCORES = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3, "credentials": 3,
    "auth": 2, "bearer": 2, "private": 2, "access": 1, "key": 1, "api": 1, "client": 1, "signing": 1, "encryption": 1,
}
NAME_STEMS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "private")
PASSING_SCORE = 4.0
LEAST_LITERAL = 8
PLACEHOLDER = re.compile(r"(?i)\A(?:x+|\*+|\.+|(?:your|my|the|some|example|changeme|placeholder|test|dummy|none|null|true|false).*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)\Z")

_SIGN = re.compile(r":=|=>|[:=]")
_NAME_BEFORE = re.compile(r"""(?:\A|[\s({,;\[<"'])["']?([A-Za-z_][\w.\-]{0,80})["']?(?:\s*:\s*[A-Za-z]\w{0,20})?[ \t]*\Z""")
_QUOTED = re.compile(r""""((?:[^"\\\n]|\\[^\n])*)"|'((?:[^'\\\n]|\\[^\n])*)'""")
_BARE_NAME = re.compile(r"[A-Za-z_][\w.]*")
_BARE_VALUE = re.compile(r"""[^\s"'#;,(){}\[\]]+(?=[ \t]*(?:[#;].*)?$)""", re.MULTILINE)
_BLANKS = re.compile(r"[ \t]*")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*(?:\\?\n[ \t]*)?|[ \t]+(?=[\"'])")
_LINE_START = re.compile(r"""\s*(?:export\s+|set\s+|-\s+)?["']*""")
#: Letters kept of a value's beginning and end, enough for every placeholder pattern.
_EDGE = 16
_HUGE = 1e12
_RUN = re.compile(r"(?i)x+\Z|\*+\Z|\.+\Z")
_LETTER_KINDS = (
    lambda c: "a" <= c <= "z", lambda c: "A" <= c <= "Z", lambda c: "0" <= c <= "9",
    lambda c: not ("a" <= c <= "z" or "A" <= c <= "Z" or "0" <= c <= "9"),
)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then by kind."""
    found: list[Span] = []
    if (":" in text or "=" in text) and any(stem in (low := text.lower()) for stem in ASSIGN_STEMS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def name_score(name: str) -> int:
    parts = [p.lower() for p in _PARTS.findall(name)]
    whole = [*parts, *(a + b for a, b in zip(parts, parts[1:], strict=False))]
    return sum(NAME_SCORES.get(p, 0) for p in whole)


class Value:
    """What a name is bound to: literals and earlier values end to end, known by their letters and not built.

    Every value refers to its parts once, so a text's values take space in proportion
    to the text however often constants are repeated and joined.
    """

    __slots__ = ("length", "letters", "head", "tail", "parts", "place")

    def __init__(self, parts: list[Value], place: tuple[int, int] | None = None, literal: str = ""):
        self.parts, self.place = parts, place
        if len(parts) == 1:
            only = parts[0]
            self.length, self.letters, self.head, self.tail = only.length, only.letters, only.head, only.tail
        elif parts:
            self.length = sum(p.length for p in parts)
            self.letters = Counter()
            for p in parts:
                self.letters.update(p.letters)
            self.head, self.tail = "", ""
            for p in parts:
                self.head = (self.head + p.head)[:_EDGE] if len(self.head) < _EDGE else self.head
                self.tail = (self.tail + p.tail)[-_EDGE:]
            if self.length > _HUGE:
                # Only shares count from here on, so the numbers stay short.
                shrink = _HUGE / self.length
                self.length, self.letters = _HUGE, Counter({c: n * shrink for c, n in self.letters.items()})
        else:
            self.length, self.letters, self.head, self.tail = len(literal), Counter(literal), literal[:_EDGE], literal[-_EDGE:]

    def score(self) -> float:
        """How random the value looks; no value for one that is short, spaced or a placeholder."""
        if self.length < LEAST_LITERAL or " " in self.letters:
            return -10.0
        # A placeholder is told by its ends, or by being one letter over and over.
        shown = self.head + self.tail if self.length > _EDGE else self.head
        if PLACEHOLDER.match(shown) and (not _RUN.match(shown) or len({c.lower() for c in self.letters}) == 1):
            return -10.0
        kinds = sum(any(test(c) for c in self.letters) for test in _LETTER_KINDS)
        entropy = -sum(n / self.length * math.log2(n / self.length) for n in self.letters.values())
        return 0.5 * (kinds - 1) + (1.0 if entropy >= 3 else 0.0)


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """(name, value) for every assignment, constants propagated."""
    bound: dict[str, Value] = {}
    line = 0
    for sign in _SIGN.finditer(text):
        line = max(line, text.rfind("\n", line, sign.start()) + 1)
        name = _NAME_BEFORE.search(text, max(0, sign.start() - 120), sign.start())
        if not name or text[sign.end() : sign.end() + 1] == "=":
            continue
        parts, at = [], _BLANKS.match(text, sign.end()).end()
        while True:
            if m := _QUOTED.match(text, at):
                group = 1 if m[1] is not None else 2
                parts.append(Value([], m.span(group), m[group]))
                at = m.end()
            elif (m := _BARE_NAME.match(text, at)) and m[0] in bound:
                parts.append(bound[m[0]])
                at = m.end()
            else:
                # A bare value counts where the assignment is alone on its line.
                if not parts and _LINE_START.fullmatch(text, line, max(line, name.start(1))) and (m := _BARE_VALUE.match(text, at)):
                    parts.append(Value([], m.span(), m[0]))
                break
            if not (joined := _JOIN.match(text, at)) or not joined[0]:
                break
            at = joined.end()
        if parts:
            bound[name[1]] = value = Value(parts)
            yield name[1], value


def lexed_spans(text: str, base: list[Span]) -> list[Span]:
    """Literals bound to sensitive names, except where a base span holds them."""
    low = text.lower()
    if not any(stem in low for stem in NAME_STEMS):
        return []
    waiting = []
    for name, value in pairs(text):
        score = name_score(name)
        if score and score + value.score() >= PASSING_SCORE:
            waiting.append(value)
    # From the values that pass down to their literals, each met once.
    found, seen = set(), set()
    while waiting:
        value = waiting.pop()
        if id(value) not in seen:
            seen.add(id(value))
            waiting += value.parts
            if value.place:
                found.add(value.place)
    starts, reach = [s for _, s, _ in base], list(accumulate((e for _, _, e in base), max))
    held = lambda s, e: (k := bisect_right(starts, s)) and reach[k - 1] >= e
    return [("lexed", s, e) for s, e in found if e > s and not held(s, e)]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_FOUND = pa.schema([("doc_id", pa.int64()), ("kind", pa.list_(pa.string())), ("start", pa.list_(pa.int64())), ("end", pa.list_(pa.int64()))])
FOUND = "doc_id long, kind array<string>, start array<long>, end array<long>"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans as the parallel arrays kind, start, end (code points, end exclusive)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                rows.append(ordered(base + lexed_spans(text, base)))
            columns = [[[s[i] for s in spans] for spans in rows] for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(_FOUND)[1:], strict=True))], schema=_FOUND)

    return docs.select("doc_id", "text").mapInArrow(scan, FOUND)


REPORT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lexed long"


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of ``scan_secrets`` per document."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spans = list(zip(row["kind"], row["start"], row["end"], strict=True))
                base = [s for s in spans if s[0] in BASE_KINDS]
                count = Counter(row["kind"])
                out.append(
                    {"doc_id": row["doc_id"], **{f"n_{k}": count[k] for k in KINDS}, "base_sha256": hashlib.sha256(listed(base).encode()).hexdigest(), "spans": listed(spans)}
                )
            types = {"base_sha256": pa.string(), "spans": pa.string()}
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_lexed"]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(n, types.get(n, pa.int64())) for n in names]))

    return scan_secrets(docs).mapInArrow(report, REPORT)
