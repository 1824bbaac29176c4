"""Secret scan: fixed patterns, and literals that are assigned to sensitive names.

The text is read as source code or configuration: names, quoted and bare
literals, and the signs between them give pairs of a name and what it is set to. A
name that is set to another name passes that name's literals on, so a constant
is found where it is written although only its use tells that it is a secret. A
literal is reported if the sensitivity of its target's name times its own
likelihood reaches ``THRESHOLD``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import text_slices, worker_path

# The base patterns and the least length of what they have to hold.
BASE = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
        ),
        2,
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
HEX_AS_ZERO = bytes(48 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
#: Kinds in the order in which spans with the same start are listed.
KINDS = (*BASE, "literal", "constant")

THRESHOLD = 0.5
#: How sensitive a word makes a name.
WORDS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "secrets": 0.9,
    "token": 1.0, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "creds": 0.9, "auth": 0.6, "authorization": 0.7,
}
#: A key is sensitive by what stands before it.
KEY_OF = {"api", "access", "secret", "private", "signing", "encryption", "auth", "master", "client", "account", "shared", "ssh"}
#: Names that end so say something about a secret and do not hold it.
ABOUT = {
    "count", "length", "len", "size", "type", "name", "id", "url", "uri", "path", "file", "field", "label", "hint", "policy",
    "expiry", "expires", "ttl", "timeout", "limit", "regex", "pattern", "prompt", "error", "message", "index", "min", "max",
    "required", "enabled", "column", "header", "param", "env", "var", "format", "prefix", "suffix",
}
#: A text without any of these in lower case has no sensitive name.
HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth")
LINE = re.compile(r"[^\r\n]*[=:][^\r\n]*")
QUOTED = r"""(?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|`(?:[^`\\]|\\.)*`)"""
PREFIXED = re.compile(f"[A-Za-z]{{1,2}}(?P<string>{QUOTED})")
TOKEN = re.compile(
    rf"""(?P<string>(?<!\w){QUOTED})"""
    r"""|(?P<name>[A-Za-z_$][\w$]*(?:(?:->|::|[.-])[A-Za-z_$][\w$]*)*)"""
    r"""|(?P<sign>:=|=>|===?|!==?|<=|>=|[=:+])"""
    r"""|(?P<space>\s+)"""
    r"""|(?P<other>.)""",
    re.ASCII,
)
KEY = re.compile(r"[A-Za-z_$][\w$. -]*", re.ASCII)
BARE = re.compile(r"""[^\s,;"'`(){}\[\]<>]+""")
TYPE_END = re.compile(r"=[^=\s]")
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
NO_SECRET = re.compile(
    r"<.*>|\$.*|\{.*|%\(.*|%.*%|(.)\1*|.*(?:example|change_?me|placeholder|your[_-]|dummy|redacted|todo).*"
    r"|none|null|nil|true|false|undefined|password|secret|string|boolean|integer",
    re.IGNORECASE | re.DOTALL,
)
REFERENCE = re.compile(r"[A-Za-z_$][\w$]*(?:(?:->|::|\.)[A-Za-z_$][\w$]*)+|(?:https?:)?//.*|/[\w./-]*", re.ASCII)


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    name: str | None
    score: float | None


class Binding(NamedTuple):
    """A name, the literals of its expression (start, end, quoted), and the bindings that the expression names."""

    name: str
    literals: list[tuple[int, int, bool]]
    uses: list[int]


def _may_hold(kind: str, text: str, low: str) -> bool:
    """A quick look whether a base pattern can match; most texts hold none of them."""
    if kind == "assign":
        return any(w in low for w in ("passw", "secret", "token", "api"))
    if kind == "access":
        return "AKIA" in text
    return b"0" * BASE[kind][2] in text.encode().translate(HEX_AS_ZERO)


def base_spans(text: str) -> list[Span]:
    found = []
    low = text.lower()
    for kind, (pattern, group, least) in BASE.items():
        for m in pattern.finditer(text) if _may_hold(kind, text, low) else ():
            if len(m[group]) >= least:
                found.append(Span(kind, m.start(), m.end(), m[1].lower() if kind == "assign" else None, None))
    return found


def name_score(name: str) -> float:
    """How likely a name holds a secret, from the words it is made of."""
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    if not parts:
        return 0.0
    score = max(WORDS.get(p, 0.0) for p in parts)
    joined = "".join(parts)
    if any(w in joined for w in ("password", "passwd", "passphrase", "apikey")):
        score = 1.0
    elif any(p + q == b + "key" for p, q in zip(parts, parts[1:], strict=False) for b in KEY_OF):
        score = max(score, 0.9)
    return score * (0.3 if parts[-1] in ABOUT and len(parts) > 1 else 1.0)


def literal_score(value: str, quoted: bool) -> float:
    """How likely a literal is a secret and not a word, a sentence, a reference or a stand-in for one."""
    if len(value) < 6 or NO_SECRET.fullmatch(value):
        return 0.0
    if REFERENCE.fullmatch(value) and not (quoted and any(c.isdigit() for c in value)):
        return 0.0
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit)) + any(
        not c.isalnum() and not c.isspace() for c in value
    )
    if any(c.isspace() for c in value):
        return 0.6 if kinds > 2 and len(value) < 100 else 0.3
    if value.isalpha():
        return (0.6 if quoted else 0.3) if value.islower() or value.istitle() else 0.75
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return 0.2 if len(counts) < 4 else 0.7 + 0.15 * (kinds > 1) + 0.15 * (bits >= 3)


def bindings(text: str) -> list[Binding]:
    """All name-literal pairs of a text, line by line, with names replaced by the binding they had at that place."""
    found: list[Binding] = []
    current: dict[str, int] = {}
    for line in LINE.finditer(text):
        _read_line(text, line.start(), line.end(), found, current)
    return found


def _read_line(text: str, at: int, end: int, found: list[Binding], current: dict[str, int]) -> None:
    """Append the bindings of one line: targets before ``=``, ``:``, ``:=`` and ``=>``, terms joined by ``+`` after it."""
    names: list[str] = []  # names and keys since the last expression
    target, sign = None, ""

    def bind(literals: list[tuple[int, int, bool]], uses: list[int]) -> None:
        if target and (literals or uses):
            found.append(Binding(target, literals, uses))
            current[target] = len(found) - 1
        elif target:
            current.pop(target, None)

    while at < end:
        m = TOKEN.match(text, at, end)
        kind, at = m.lastgroup, m.end()
        if kind == "name":
            names.append(m[0])
        elif kind == "string" and KEY.fullmatch(m[0][1:-1]):
            names.append(m[0][1:-1])
        elif kind == "sign" and m[0] in ("=", ":", ":=", "=>"):
            # "name: type = value" keeps the name, and so does "var name type = value"
            if not (m[0] == "=" and sign == ":" and target):
                target = names[-1] if names else None
            if len(names) > 2 and names[-3] == "var":
                target = names[-2]
            sign, names = m[0], []
            literals, uses, at, typed = _read_terms(text, at, end, current, sign == ":")
            if not (sign == ":" and typed and text.startswith("=", at)):
                bind(literals, uses)
                sign = ""
        elif kind == "other" and m[0] not in "])}\"'":
            names, sign = [], ""


def _read_terms(text: str, at: int, end: int, current: dict[str, int], colon: bool) -> tuple[list, list, int, bool]:
    """Literals and uses of an expression, where it stops, and whether it is a name, as a type after a colon is."""
    literals: list[tuple[int, int, bool]] = []
    uses: list[int] = []
    typed = False
    while True:
        while at < end and text[at] in " \t(":
            at += 1
        m = (PREFIXED.match(text, at, end) or TOKEN.match(text, at, end)) if at < end else None
        if m is None:
            break
        if m.lastgroup == "string":
            literals.append((m.start("string") + 1, m.end() - 1, True))
            at = m.end()
        else:
            run = BARE.match(text, at, end)
            if run is None:
                break
            terms = [t for t in run[0].split("+") if t]
            known = [current[t] for t in terms if t in current]
            at, typed = run.end(), m.lastgroup == "name"
            if known and len(known) == len(terms):
                uses += known
            elif colon and typed and TYPE_END.match(text, m.end(), end):
                at = m.end()
                break
            elif at < end and text[at] in "([":
                break  # a call or an element, no literal
            else:
                literals.append((run.start(), run.end(), False))
        while at < end and text[at] in " \t":
            at += 1
        if not (at < end and text[at] == "+"):
            break
        at += 1
    return literals, uses, at, typed


def assigned_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, each once, for the most sensitive of its targets.

    A binding is visited once however many names lead to it, so the work is in
    proportion to the text.
    """
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    found = bindings(text)
    scores = [name_score(b.name) for b in found]
    seen: set[int] = set()
    spans: dict[tuple[int, int], Span] = {}
    for start in sorted((i for i, s in enumerate(scores) if s >= THRESHOLD), key=lambda i: (-scores[i], i)):
        waiting = [start]
        while waiting:
            i = waiting.pop()
            if i in seen:
                continue
            seen.add(i)
            waiting += found[i].uses
            literals = found[i].literals
            value = "".join(text[a:b] for a, b, _ in literals)
            score = scores[start] * literal_score(value, any(q for *_, q in literals))
            if score >= THRESHOLD:
                kind = "literal" if scores[i] >= THRESHOLD else "constant"
                for a, b, _ in literals:
                    spans.setdefault((a, b), Span(kind, a, b, found[start].name, round(score, 3)))
    return list(spans.values())


def spans_of(text: str | None) -> list[Span]:
    """All spans by start, then kind; a literal inside a span of a base pattern is not told again."""
    if not text:
        return []
    base = base_spans(text)
    added = assigned_spans(text)
    if added and base:
        starts = sorted(s.start for s in base)
        ends = list(accumulate((s.end for s in sorted(base, key=lambda s: s.start)), max))
        reach = [0, *ends]
        added = [s for s in added if reach[bisect_right(starts, s.start)] < s.end]
    return sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and secrets (kind, start, end, name, score) for each row of ``docs``, over its whole text.

    Positions are code points, the end is exclusive. Kinds: those of ``BASE``, whose
    spans are whole matches; ``literal``, set to a sensitive name; ``constant``,
    set to another name from which it reaches a sensitive one. For the last two
    the span is the literal without its quotes, ``name`` the sensitive name and ``score`` what it was rated.

    A null or empty text has no secrets. Equal rows each give a row; doc_id may be null.
    Columns other than doc_id and text are left out, whatever their names. Nothing is shuffled.
    """
    worker_path(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    fields = "array<struct<kind: string, start: long, end: long, name: string, score: double>>"
    kind = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [[s._asdict() for s in spans_of(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, kind)], ["doc_id", "secrets"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, secrets {fields}")


def digest(docs: DataFrame) -> DataFrame:
    """Counts and a digest of the base spans, and all spans as text."""
    secrets = F.col("secrets")

    def of(*kinds: str) -> Column:
        return F.filter(secrets, lambda s: s["kind"].isin(*kinds))

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return scan(docs).select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(shown(of(*BASE)), 256).alias("base_sha256"),
        shown(secrets).alias("spans"),
    )
