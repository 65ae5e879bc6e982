"""Secret scans: assignments are lexed into name-literal pairs, and literals scored by the name they end up under.

Source and configuration syntax is read as assignments: a name (bare, dotted,
quoted, or a quoted key in brackets), ``=``, ``:``, ``:=`` or ``=>``, and a value
(quoted string, bare literal, or another name). A value that is a name stands for
the literal that name was last given, over any number of steps. A literal's score
is how sensitive its most sensitive name is, times how much it looks like a
secret. Fixed patterns (assignments to plain key words, access key ids, long hex
runs) are found as well and never taken back.

Defined cases: null and empty texts have no spans; spans with the same start are
listed by kind; repeated rows get equal results; a table without rows gives none; extra columns pass through, and input columns named like an added one are
replaced. Places are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import add_columns, set_aside

# Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "literal")
BASE_KINDS = KINDS[:3]
MIN_SCORE = 0.5
PLACEHOLDER = "[SECRET]"

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("value_start", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64()), ("score", pa.float64())]))

# The base patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# How sensitive a part of a name is, and pairs of parts that are so only together.
_PARTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 0.9, "pw": 0.6, "secret": 1.0, "secrets": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.7, "creds": 0.8, "auth": 0.6, "bearer": 0.8,
    "authorization": 0.7, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "dsn": 0.6, "salt": 0.5, "pin": 0.5,
}
_PAIRS = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("signing", "key"): 0.9, ("encryption", "key"): 0.9, ("account", "key"): 0.9, ("client", "key"): 0.8, ("master", "key"): 0.9, ("session", "key"): 0.8, ("ssh", "key"): 0.9}
# Parts that turn a name into one about secrets, not of one.
_HARMLESS = {"url", "uri", "path", "file", "name", "id", "type", "length", "len", "count", "ttl", "expiry", "expires", "hint", "policy", "regex", "pattern", "field", "header", "label", "endpoint", "enabled", "max", "min"}
_DUMMY = re.compile(r"(?i)^(?:none|null|nil|true|false|undefined|changeme|change_me|example|placeholder|your[\w-]*|x+|\*+|\.+|-+|todo|test|string|str|int|redacted|\$\{.*|<.*|%.*|\{\{.*)$")

_VALUE = r"""(?P<quoted>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)|(?P<bare>[^\s"'`,;(){}\[\]<>]+)"""
_PAIR = re.compile(
    r"""(?:\[\s*["'](?P<key>[\w.$-]+)["']\s*\]|["'](?P<word>[\w.$-]+)["']|(?<![\w.$-])(?P<name>[A-Za-z_$][\w.$-]*))"""
    r"""\s*+(?::\s*+[A-Za-z_][\w.\[\]]*+\s*+(?==[^=>]))?(?:=>|:=|(?<![=!<>])=(?!=)|:(?![:=/]))[ \t]*+(?:"""
    + _VALUE
    + r")",
    re.A,
)
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_NAME = re.compile(r"[A-Za-z_$][\w.$]*", re.A)


def sensitivity(name: str) -> float:
    """0 to 1: how likely what is assigned to ``name`` is secret."""
    parts = [p.lower() for p in _CAMEL.findall(name)]
    if not parts or parts[-1] in _HARMLESS:
        return 0.0
    return max([_PARTS.get(p, 0.0) for p in parts] + [_PAIRS.get(p, 0.0) for p in zip(parts, parts[1:])])


def secrecy(literal: str) -> float:
    """0 to 1: how much a literal looks like a secret, by length, kinds of characters and their spread."""
    if len(literal) < 6 or _DUMMY.match(literal) or " " in literal.strip() and len(literal) > 40:
        return 0.0
    kinds = sum(bool(re.search(k, literal)) for k in (r"[a-z]", r"[A-Z]", r"\d", r"[^A-Za-z0-9]"))
    spread = -sum(c / len(literal) * math.log2(c / len(literal)) for c in map(literal.count, set(literal)))
    return min(1.0, 0.35 + 0.15 * kinds + 0.08 * max(0.0, spread - 2.0))


def literals(text: str) -> list[tuple[int, int, float]]:
    """Places and scores of literals under sensitive names."""
    values: dict[str, tuple[int, int, str]] = {}
    names: dict[tuple[int, int], float] = {}
    read: dict[tuple[int, int], str] = {}
    for m in _PAIR.finditer(text):
        name = m["key"] or m["word"] or m["name"]
        if m["quoted"] is not None:
            start, end = m.start("quoted") + 1, m.end("quoted") - 1
            value = text[start:end]
        else:
            start, end = m.span("bare")
            value = m["bare"].rstrip(".:")
            end = start + len(value)
            # A bare word may be a name that stands for a literal.
            if _NAME.fullmatch(value) and value in values:
                start, end, value = values[value]
        values[name] = start, end, value
        if (known := sensitivity(name)) > 0 and end > start:
            names[start, end] = max(known, names.get((start, end), 0.0))
            read[start, end] = value
    found = [(s, e, known * secrecy(read[s, e])) for (s, e), known in names.items()]
    return sorted(x for x in found if x[2] >= MIN_SCORE)


def find(text: str) -> list[tuple[str, int, int, int, float]]:
    """(kind, start, end, start of the value, score) by start, then by kind."""
    low = text.lower()
    spans: list[tuple[str, int, int, int, float]] = []
    if "pass" in low or "secret" in low or "token" in low or "key" in low:
        spans += [("assign", m.start(), m.end(), m.start(2), 1.0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), m.start(), 1.0) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end(), m.start(), 1.0) for m in _HEX.finditer(text)]
    # Lexed only where some name can be sensitive at all.
    if ("=" in text or ":" in text) and any(p in low for p in _STEMS):
        base = sorted((s, e) for _, s, e, _, _ in spans)
        reach = list(accumulate((e for _, e in base), max))
        for s, e, score in literals(text):
            # Base spans that begin no later: some one reaches its end, or it is not inside any.
            k = bisect_right(base, (s, math.inf))
            if not k or reach[k - 1] < e:
                spans.append(("literal", s, e, s, score))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


# Every sensitive name holds one of these.
_STEMS = sorted({p for p in _PARTS if not any(q != p and q in p for q in _PARTS)} | {"key"})


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``secret_spans``: kind, start, end, start of the value, score."""

    def work(texts: pa.Array) -> list[pa.Array]:
        names = ("kind", "start", "end", "value_start", "score")
        return [pa.array([[dict(zip(names, x)) for x in find(t)] if t else [] for t in texts.to_pylist()], _ARROW)]

    return add_columns(docs, "text", T.StructType([T.StructField("secret_spans", SPANS)]), work, keep)


def redact(docs: DataFrame, placeholder: str = PLACEHOLDER) -> DataFrame:
    """``docs`` with the value of each span replaced; a name in front of it stays."""

    def work(texts: pa.Array) -> list[pa.Array]:
        out = []
        for text in texts.to_pylist():
            if text and (spans := find(text)):
                parts, at = [], 0
                for _, _, end, start, _ in sorted(spans, key=lambda x: x[3]):
                    if start >= at:
                        parts += [text[at:start], placeholder]
                    at = max(at, end)
                text = "".join(parts) + text[at:]
            out.append(text)
        return [pa.array(out, pa.string())]

    docs, back = set_aside(docs, ["secret_spans"])
    return back(add_columns(docs, "text", T.StructType([T.StructField("text", T.StringType())]), work))


def listed(kinds: tuple[str, ...], spans: str = "secret_spans"):
    """The spans of these kinds as kind:start:end, comma-joined."""
    own = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def counted(kind: str, spans: str = "secret_spans"):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
