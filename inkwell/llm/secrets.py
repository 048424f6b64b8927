"""Secret scan with assignment-aware lexing.

Two layers give spans (kind, start, end) in code points, end exclusive:

* Base patterns: ``assign`` (a password-like name and its value), ``access`` (key ids) and
  ``hex`` (long lower-case hex runs), leftmost and non-overlapping per kind.
* ``named``: a lexer reads assignments of source code and configuration files (``a = "b"``,
  ``a: b``, ``"a": "b"``, ``a := 'b'``, ``a => "b"``, ``export A=b``, joined literals
  ``"b" + "c"``, literals in triple or back quotes, YAML blocks) into name-literal pairs. A
  name that is assigned another name takes over the literals that name holds at this point
  (constant propagation). A bare word that may be a name counts as a literal only where
  configuration files have one (``A=b``, or ``a: b`` alone on its line) or if it mixes upper
  case, lower case and digits; calls are no literals. Each literal is scored
  by the sensitive words in the target's name and by its own make-up; those that reach
  ``min_score`` are spans of the literal's text.

Null and empty texts have no spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from inkwell.llm.common import small_batches

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LENGTH = 6
KINDS = ("assign", "access", "hex", "named")

# What words of a target name say about its literal.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6, "secret": 1.0, "token": 0.8, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "auth": 0.5, "bearer": 0.8, "private": 0.4, "key": 0.4, "access": 0.3, "api": 0.4,
    "signing": 0.4, "encryption": 0.4, "salt": 0.5, "cookie": 0.4, "session": 0.3, "webhook": 0.3, "connection": 0.2,
}
HARMLESS = {"name": -0.5, "id": -0.2, "path": -0.5, "file": -0.5, "url": -0.3, "type": -0.6, "length": -0.8, "count": -0.8, "field": -0.5, "label": -0.5, "public": -0.5, "expiry": -0.6, "ttl": -0.8, "header": -0.4}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*|changeme.*|example.*|your[-_ ].*|todo.*|none|null|true|false|undefined|placeholder.*|dummy.*|test)$")

MIN_SCORE = 0.9
MIN_LITERAL = 6
PHRASE = 0.2  # reaches MIN_SCORE with LEAST_NAME
LEAST_NAME = 0.7  # of any listed word: eight characters of three classes (0.2 or more) reach MIN_SCORE

_NAME = r"[A-Za-z_$][\w$]*(?:(?:\.|->|::|-)[A-Za-z_$][\w$]*|\[\s*[\"'][\w.-]+[\"']\s*\])*"
_STRING = r"(?:[rbuf]{0,2}(?:\"{3}(?s:.*?)\"{3}|'{3}(?s:.*?)'{3}|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*')|`[^`]*`)"
# a type between name and operator stays on the line and is read once
_TYPE = r"(?:[ \t]*+:[ \t]*+[A-Za-z_][\w\[\],.| \t]*+(?==))?"
_TARGET = re.compile(rf"(?<![\w$.])(?<!\w-)(?:(?P<q>[\"'])(?P<qname>[\w.-]+)(?P=q)|(?P<name>{_NAME})){_TYPE}[ \t]*+(?P<op>:=|=>|=(?![=>~])|:(?![:/]))[ \t]*+")
_VALUE = re.compile(
    rf"(?P<joined>{_STRING}(?:(?:\s*+[+.]\s*+(?:\\\n\s*+)?|[ \t]*+\\\n[ \t]*+){_STRING})*|\(\s*+{_STRING}(?:\s*+(?:[+.]\s*+)?{_STRING})*\s*+\))"
    rf"|(?P<ref>{_NAME})(?=[ \t]*+(?:[;,)}}\]#]|$))|(?P<bare>[^\s\"'`,;(){{}}\[\]<>]+)",
    re.MULTILINE,
)
_LITERAL = re.compile(_STRING)
_QUOTES = re.compile(r"\"{3}|'{3}|[\"'`]")
_BLOCK = re.compile(r"[|>][-+\d]*[ \t]*+(?:#[^\n]*)?\n")
_LINE_END = re.compile(r"\r?\n[ \t]*")
_PARTS = re.compile(r"\.|->|::|\[")
_NAME_ONLY = re.compile(_NAME)
_OPERATOR = re.compile(r"[:=]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("access", m.start(), m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    return _ordered(found)


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _words(name: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)]


def name_score(name: str) -> float:
    """Sum of what the words of a name say, LEAST_NAME at least for sensitive ones; camel case and separators part words."""
    words = _words(name)
    sensitive = sum(SENSITIVE.get(w, 0) for w in words)
    return (max(LEAST_NAME, sensitive) if sensitive else 0) + sum(HARMLESS.get(w, 0) for w in words)


def literal_score(value: str) -> float:
    """-inf for short values and placeholders, 0 for phrases; up to 0.4 for mixed classes and high entropy."""
    if len(value) < MIN_LITERAL or PLACEHOLDER.match(value.strip()):
        return -math.inf
    if " " in value.strip():
        return 0.0
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit))
    return min(0.4, 0.1 * (classes - 1) + 0.05 * max(0.0, entropy - 2))


def pair_score(name: str, value: str) -> float:
    """Name and literal together, line ends and indents apart; a phrase counts for names of passwords and tokens."""
    n, value = name_score(name), _LINE_END.sub("", value)
    if n <= 0:
        return -math.inf
    phrase = PHRASE if " " in value.strip() and any(SENSITIVE.get(w, 0) >= 0.6 for w in _words(name)) else 0
    return n + phrase + literal_score(value)


def _key(name: str) -> str:
    """Names compare by their last part, however they are joined."""
    return _PARTS.split(name)[-1].strip("]\"' \t\n")


def _inner(text: str, low: int, high: int) -> Iterator[tuple[int, int]]:
    """What stands within the quotes of the literals of a stretch."""
    for s in _LITERAL.finditer(text, low, high):
        q = _QUOTES.search(text, s.start(), s.end())
        width = len(q[0]) if s.end() - q.start() >= 2 * len(q[0]) else 1
        yield q.start() + width, s.end() - width


def _yaml_block(text: str, target: int, at: int) -> tuple[int, int] | None:
    """Lines below that are indented more than the line of the target."""
    line = text.rfind("\n", 0, target) + 1
    indent = target - line
    if text[line:target].strip(" -"):
        return None
    low = high = None
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        row = text[at:end]
        if bare := row.strip():
            lead = len(row) - len(row.lstrip(" "))
            if lead <= indent:
                break
            low, high = at + lead if low is None else low, at + row.index(bare) + len(bare)
        at = end + 1
    return None if low is None else (low, high)


def _is_literal(text: str, m: re.Match, v: re.Match) -> bool:
    """Whether a bare word is a value and not a name or a call."""
    word, end = v[0], v.end()
    if end < len(text) and text[end] in "([{":
        return False
    if not _NAME_ONLY.fullmatch(word):
        return True
    if all(any(f(c) for c in word) for f in (str.islower, str.isupper, str.isdigit)) and not _PARTS.search(word):
        return True
    tight = m["op"] == "=" and m.end() == m.end("op") and text[m.start("op") - 1] not in " \t"
    alone = m["op"] == ":" and (m.start() == 0 or text[m.start() - 1] in "\n \t-") and text[end : end + 1] in ("", "\n", "\r", " ", "\t")
    return (tight or alone) and text[end : end + 1] not in (";", ",", ")")


def name_literal_pairs(text: str) -> Iterator[tuple[str, int, int]]:
    """(target name, start, end) of every literal that reaches the name, in reading order.

    A later assignment to a name replaces what it held; names compare by their last part.
    """
    held: dict[str, list[tuple[int, int]]] = {}
    at = 0
    while m := _TARGET.search(text, at):
        name = m["qname"] or m["name"]
        at = m.end()
        if m["op"] == ":" and (b := _BLOCK.match(text, at)) and (block := _yaml_block(text, m.start(), b.end())):
            held[_key(name)] = [block]
            yield name, *block
            continue
        v = _VALUE.match(text, at)
        if not v:
            continue
        if v["joined"]:
            spans = list(_inner(text, v.start(), v.end()))
            at = v.end()
        elif v["ref"] and _key(v["ref"]) in held:
            spans = held[_key(v["ref"])]
            at = v.end()
        else:
            # a bare word may itself be the target of a chained assignment: read on from its start
            spans = [(v.start(), v.end())] if _is_literal(text, m, v) else []
        held[_key(name)] = spans
        yield from ((name, *s) for s in spans)


def named_spans(text: str, min_score: float = MIN_SCORE) -> list[tuple[str, int, int]]:
    if not _OPERATOR.search(text):
        return []
    found = {(a, b) for name, a, b in name_literal_pairs(text) if round(pair_score(name, text[a:b]), 9) >= min_score}
    return [("named", a, b) for a, b in found]


def secret_spans(text: str, min_score: float = MIN_SCORE) -> list[tuple[str, int, int]]:
    """All spans by start, then kind in the order of KINDS."""
    return _ordered(base_spans(text) + named_spans(text, min_score))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """Replace what the spans cover by the mark; of an ``assign`` span only the value goes."""
    hidden = sorted((ASSIGN.match(text, a).start(2) if kind == "assign" else a, b) for kind, a, b in spans)
    out, at = [], 0
    for a, b in hidden:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, keep: list[str], text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``keep`` columns with ``secrets``: an array of (kind, start, stop). No shuffle."""
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    schema = T.StructType([*docs.select(*keep).schema.fields, *T._parse_datatype_string("secrets array<struct<kind:string,start:bigint,stop:bigint>>").fields])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in secret_spans(t or "", min_score)] for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, kind)], names=[*keep, "secrets"])

    return docs.select(*keep, text).mapInArrow(found, schema)


def secrets_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (and n_named) of each row, doc_id null or not."""
    small_batches(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                spans = secret_spans(t or "")
                base = [s for s in spans if s[0] != "named"]
                n = Counter(s[0] for s in spans)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), n["named"]))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_named"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_named long"
    return docs.select("doc_id", "text").mapInArrow(digest, schema)


def redact_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with secrets replaced by ``mark`` and ``length`` set anew where a text changed.

    Null texts stay null; a missing ``length`` column is not added.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    at, n_at = names.index(text), names.index(length) if length in names else None

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [t and redact(t, secret_spans(t), mark) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, pa.string())
            if n_at is not None:
                sizes = [len(b) if a != b else n for a, b, n in zip(old, new, columns[n_at].to_pylist(), strict=True)]
                columns[n_at] = pa.array(sizes, columns[n_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(redacted, docs.schema)
