"""Secrets in texts: fixed patterns, and assignments read by a small lexer.

The base patterns find assignments to tell-tale names, access keys and long hexadecimal runs.
The lexer then reads source and configuration syntax line by line into (name, literal) pairs:
``name = "literal"``, ``name: literal``, ``"name": "literal"``, ``name => 'literal'``, with
attribute and index paths, ``export``/``const`` before the name, and ``+`` between parts.
Constants are propagated: a name that was given a literal hands it on where it is assigned to
another name or joined with other parts. Without quotes, what stands up to white space or a
delimiter is a reference only if all of it is a name (or a join of known names); any other
token is a literal as a whole, and assignments inside it (``url?name=literal&``) count too. Each literal is scored by the words of the names it
reaches and by its own shape; literals at or above the threshold become spans of kind
``literal``, except where a base span already covers them.

Defined cases: a NULL or empty text has no spans; a name that is assigned again holds the last
literal before its use; placeholders such as ``changeme`` or ``${VAR}`` score nothing. All
positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Container, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import text_batches

Span = tuple[str, int, int]

# The base patterns, their order, and the least number of characters.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a greedy run of 32 or more is a match of its run
KINDS = ("assign", "access", "hex", "literal")
LEAST_VALUE, LEAST_ACCESS = 8, 16

THRESHOLD = 0.6
CHUNK_BYTES = 4 << 20

# Words of names and how telling they are.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8,
    "private": 0.7, "bearer": 0.8, "signing": 0.6, "encryption": 0.6, "access": 0.5, "key": 0.5,
    "salt": 0.5, "session": 0.4, "cert": 0.4,
}
# What marks a placeholder: anywhere, or as all of the literal.
HOLES = ("${", "{{", "%(")
PLACEHOLDER = re.compile(
    r"(changeme|change_me|example|password|secret|token|none|null|true|false|todo|test|dummy|placeholder)\Z"
    r"|your[-_ ]", re.I)
HEAD = 16  # longer than any of these

NAME = r"[A-Za-z_$][\w$]*(?:(?:\.|->|::)[A-Za-z_$][\w$]*|\[[\"'][^\"'\]\n]+[\"']\]|-[A-Za-z_][\w$]*)*"
STRING = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"
ASSIGNS = r"(?::=|=>|=(?![=~])|:(?!:|//))"
# A name is taken whole, and with or without an assignment: a search that goes on behind it
# instead of inside it takes linear time.
TARGET = re.compile(rf"(?P<quoted>[\"'])(?P<key>[^\"'\n]+)(?P=quoted)[ \t]*{ASSIGNS}[ \t]*"
                    rf"|(?<![\w$])[^\W_A-Za-z]*(?P<name>(?>{NAME}))(?P<op>[ \t]*{ASSIGNS}[ \t]*)?")
PART = re.compile(rf"(?P<string>{STRING})|(?P<ref>{NAME})(?![\w(\"'])|(?P<bare>[^\s\"'`,;(){{}}\[\]#]+)")
BARE = re.compile(r"[^\s\"'`,;(){}\[\]#]+")
REF = re.compile(NAME)
NAMES = re.compile(rf"{NAME}(?:\+{NAME})*+")
QUOTES = ("\"", "'", "`")
PLUS = re.compile(r"[ \t]*[+.][ \t]*(?=[\"'`A-Za-z_$])")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[Span]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def name_score(name: str) -> float:
    """How much a name says that its value is secret: the best of its words, with a bonus
    where several tell."""
    words = [word.lower() for word in WORDS.findall(name)]
    pairs = [a + b for a, b in zip(words, words[1:])]
    weights = sorted((NAME_WEIGHTS[word] for word in words + pairs if word in NAME_WEIGHTS), reverse=True)
    return min(1.0, weights[0] + 0.25 * len(weights[1:])) if weights else 0.0


class Value:
    """What an assignment gives a name: a literal, or values joined with ``+``. Only sums are
    kept of what is joined, so that a value takes one pass over its own text, whatever its
    length and however often it is handed on."""

    __slots__ = ("span", "joined", "length", "counts", "head", "tail", "hole", "score")

    def __init__(self, content: str = "", span: tuple[int, int] | None = None):
        self.span, self.joined, self.score = span, (), 0.0
        self.length, self.counts = len(content), Counter(content)
        self.head, self.tail = content[:HEAD], content[-1:]
        opened = content.find("<")
        self.hole = any(hole in content for hole in HOLES) or opened >= 0 and content.find(">", opened) >= 0

    @classmethod
    def of(cls, joined: list[Value]) -> Value:
        value = cls()
        value.joined = tuple(joined)
        for part in joined:
            value.hole |= (part.hole or value.tail + part.head[:1] in HOLES
                           or "<" in value.counts and ">" in part.counts)
            value.length += part.length
            value.counts.update(part.counts)
            if len(value.head) < HEAD:
                value.head = (value.head + part.head)[:HEAD]
            value.tail = part.tail or value.tail
        return value

    def placeholder(self) -> bool:
        of_one = len(self.counts) <= 2 and {char.lower() for char in self.counts} in ({"x"}, {"*"}, {"."})
        return self.hole or of_one or PLACEHOLDER.match(self.head) is not None

    def literal_score(self) -> float:
        """How much the value looks like a secret: length, variety and mixture of characters."""
        if self.length < LEAST_VALUE or self.placeholder():
            return 0.0
        shares = [n / self.length for n in self.counts.values()]
        entropy = -sum(share * math.log2(share) for share in shares if share)
        lower, upper = (any(first <= char <= last for char in self.counts) for first, last in ("az", "AZ"))
        code = lower and upper or any(char.isdecimal() or char in "-_+/=." for char in self.counts)
        if " " in self.counts and not code:
            return 0.2
        return min(1.0, entropy / 3.5) * (1.0 if code else 0.7)


def literal_score(literal: str) -> float:
    return Value(literal).literal_score()


def parts_at(text: str, at: int, known: Container[str]) -> tuple[list[tuple[str, str, int, int]], int]:
    """The parts of the operand at a position, and where it ends."""
    part = PART.match(text, at)
    if part is None:
        return [], at
    if part["string"] is not None:
        return [("literal", part["string"][1:-1], part.start() + 1, part.end() - 1)], part.end()
    token = BARE.match(text, at)
    end = token.end()
    joined = text.startswith(QUOTES, end) and text[end - 1] in "+." and end - 1 > at
    names = NAMES.match(text, at)
    if names is not None and names.end() >= end - joined:
        refs = REF.findall(names[0])
        if len(refs) == 1 or joined or all(ref in known for ref in refs):
            if part["ref"] is None:  # a call
                return [("literal", token[0], at, end)], end
            if len(refs) == 1:
                return [("ref", part["ref"], at, part.end())], part.end()
            return [("ref", ref, at, names.end()) for ref in refs], names.end()
    whole = [("literal", token[0], at, end)]
    if part["ref"] is not None and part["ref"] in known:  # an expression that uses a constant
        whole.append(("ref", part["ref"], at, part.end()))
    return whole, end


def next_target(text: str, at: int) -> re.Match | None:
    """The next name or quoted key that something is assigned to."""
    while (found := TARGET.search(text, at)) is not None and found["name"] and not found["op"]:
        at = found.end()
    return found


def targets(text: str) -> Iterator[re.Match]:
    at = 0
    while (found := next_target(text, at)) is not None:
        yield found
        at = found.end()


def inside(text: str, start: int, end: int) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """Assignments inside an unquoted token: of each piece up to ``&`` the most telling name,
    with all that follows the first telling one."""
    for piece in re.finditer("[^&]+", text[start:end]):
        best, at = (0.0, ""), None
        for target in targets(piece[0]):
            name = target["name"] or target["key"]
            if weight := name_score(name):
                best = max(best, (weight, name))
                at = target.end() if at is None else at
        if at is not None and at < len(piece[0]):
            begin = start + piece.start()
            yield best[1], [("literal", piece[0][at:], begin + at, begin + len(piece[0]))]


def assignments(text: str, known: Container[str]) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """(name, parts) of what looks like an assignment; a part is (kind, content, start, end),
    a literal or a reference to a name. ``known`` are the names assigned so far."""
    at = 0
    while (target := next_target(text, at)) is not None:
        at = target.end()
        parts, tokens = [], []
        while True:
            found, end = parts_at(text, at, known)
            if not found:
                break
            if found[0][0] == "literal" and found[0][2] == at:  # without quotes
                tokens.append((at, end))
            parts += found
            at = end
            plus = PLUS.match(text, at)
            if plus is None:
                break
            at = plus.end()
        yield target["name"] or target["key"], parts
        for token in tokens:
            yield from inside(text, *token)


def literal_spans(text: str) -> list[Span]:
    """Spans of literals that reach a sensitive name."""
    known: dict[str, Value] = {}
    made: list[Value] = []  # what is joined stands before what it is joined to
    for name, parts in assignments(text, known):
        joined = []
        for kind, content, start, end in parts:
            if kind == "ref" and content in known:
                joined.append(known[content])
            elif kind == "literal" or len(parts) == 1:  # or a bare word of a configuration file
                joined.append(Value(content, (start, end)))
                made.append(joined[-1])
        value = joined[0] if len(joined) == 1 else Value.of(joined)
        if len(joined) > 1:
            made.append(value)
        known[name] = value
        if value.length and (weight := name_score(name)):
            value.score = max(value.score, weight * value.literal_score())
    best: dict[tuple[int, int], float] = {}
    for value in reversed(made):
        for part in value.joined:
            part.score = max(part.score, value.score)
        if value.span is not None:
            best[value.span] = max(value.score, best.get(value.span, 0.0))
    return [("literal", start, end) for (start, end), score in best.items()
            if score >= THRESHOLD and end > start]


def secret_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """The base spans and all spans of a text."""
    if not text:
        return [], []
    base = base_spans(text)
    if "=" not in text and ":" not in text:
        return base, base
    added = []
    for span in sorted(literal_spans(text), key=lambda span: span[1:]):
        if not any(start <= span[1] and span[2] <= end for _, start, end in base):
            added.append(span)
    return base, in_order(base + added)


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, CHUNK_BYTES):
        numbers, digests, spans = [], [], []
        for text in batch.column(1).to_pylist():
            base, found = secret_spans(text)
            numbers.append([sum(kind == name for kind, _, _ in base) for name in KINDS[:3]])
            digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            spans.append(written(found))
        counts = list(zip(*numbers)) if numbers else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(column, pa.int64()) for column in counts],
             pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Spans of secrets of every row of ``documents`` (doc_id, text), as RESULT."""
    return documents.select("doc_id", "text").mapInArrow(scan_task, RESULT)


def mask_secrets(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``documents`` with each secret in ``text`` replaced by ``mask``, overlapping spans by
    one; a column ``n_chars`` is counted anew."""
    names = documents.columns
    at = names.index("text")

    def masked(text: str | None) -> str | None:
        spans = secret_spans(text)[1]
        if not spans:
            return text
        out, end = [], 0
        for _, start, stop in sorted(spans, key=lambda span: span[1:]):
            if start >= end:
                out += [text[end:start], mask]
            end = max(end, stop)
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, CHUNK_BYTES):
            columns = list(batch.columns)
            texts = [masked(text) for text in columns[at].to_pylist()]
            columns[at] = pa.array(texts, columns[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                sizes = [None if text is None else len(text) for text in texts]
                columns[k] = pa.array(sizes, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.mapInArrow(run, documents.schema)
