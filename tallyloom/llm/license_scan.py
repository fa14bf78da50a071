"""Licences named in texts: tags, notices and licence expressions.

One Aho-Corasick automaton runs over the words of a text and finds notice phrases ("under
the mit license") and the words that introduce an expression ("spdx license identifier").
After the latter an expression is read from the text itself, turned into reverse Polish
order by the shunting-yard method, and evaluated against a policy: ``or`` is a choice,
``and`` binds both sides, ``with`` adds an exception to one licence.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. All of it
is done on UTF-8 bytes, in pieces of at most CHUNK_BYTES plus the words a phrase may reach
beyond them, so that the memory of a task does not depend on the length of a text.

Defined cases: a NULL or empty text has no words, no places and the score 0; rows with a
NULL or repeated id are scanned one by one; an empty table gives no rows; further columns
of the input are not read. Overlapping places all count.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import text_batches

CHUNK_BYTES = 4 << 20
BATCH_BYTES = 8 << 20

# How far a licence reaches, from least to most demanding.
PUBLIC, PERMISSIVE, WEAK, STRONG, NETWORK, RESTRICTED = range(6)

# Identifiers of licences and how far they reach.
LICENSES = {
    "0BSD": PUBLIC, "CC0-1.0": PUBLIC, "Unlicense": PUBLIC, "WTFPL": PUBLIC,
    "AFL-3.0": PERMISSIVE, "Apache-1.1": PERMISSIVE, "Apache-2.0": PERMISSIVE,
    "Artistic-2.0": PERMISSIVE, "BSD-2-Clause": PERMISSIVE, "BSD-3-Clause": PERMISSIVE,
    "BSD-4-Clause": PERMISSIVE, "BSL-1.0": PERMISSIVE, "ISC": PERMISSIVE, "MIT": PERMISSIVE,
    "MIT-0": PERMISSIVE, "NCSA": PERMISSIVE, "PSF-2.0": PERMISSIVE, "PostgreSQL": PERMISSIVE,
    "Python-2.0": PERMISSIVE, "X11": PERMISSIVE, "Zlib": PERMISSIVE, "OFL-1.1": PERMISSIVE,
    "CDDL-1.0": WEAK, "EPL-1.0": WEAK, "EPL-2.0": WEAK, "MPL-1.1": WEAK, "MPL-2.0": WEAK,
    "MS-PL": WEAK, "OSL-3.0": STRONG, "EUPL-1.2": STRONG, "BUSL-1.1": RESTRICTED,
    "SSPL-1.0": RESTRICTED, "Elastic-2.0": RESTRICTED,
}
# Families whose identifiers follow a rule.
GNU = {"GPL": (STRONG, ("1.0", "2.0", "3.0")), "LGPL": (WEAK, ("2.0", "2.1", "3.0")),
       "AGPL": (NETWORK, ("3.0",))}
COMMONS = {"CC-BY": PERMISSIVE, "CC-BY-SA": STRONG, "CC-BY-NC": RESTRICTED,
           "CC-BY-ND": RESTRICTED, "CC-BY-NC-SA": RESTRICTED, "CC-BY-NC-ND": RESTRICTED}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# Exceptions that free linked works from the licence.
EXCEPTIONS = ("Classpath-exception-2.0", "GCC-exception-3.1", "LLVM-exception",
              "Linux-syscall-note", "Autoconf-exception-3.0", "Bison-exception-2.2",
              "OpenSSL-exception", "Font-exception-2.0")
# Other spellings of identifiers.
SPELLINGS = {"apache2": "Apache-2.0", "apache-2": "Apache-2.0", "bsd-2": "BSD-2-Clause",
             "bsd-3": "BSD-3-Clause", "expat": "MIT", "gplv2": "GPL-2.0-only",
             "gplv3": "GPL-3.0-only", "lgplv3": "LGPL-3.0-only", "agplv3": "AGPL-3.0-only",
             "mpl2": "MPL-2.0", "boost": "BSL-1.0", "cc0": "CC0-1.0"}
# Labels that differ from the identifier in lower case.
LABELS = {"Apache-2.0": "apache-2"}

# The phrases every scan looks for, and further notices. A phrase is given
# by its words, a label by the name it is reported under.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2",
                "cc by nc": "cc-by-nc"}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the mit license": "mit",
    "licensed under the apache license": "apache-2",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "boost software license version 1 0": "bsl-1.0",
    "sil open font license": "ofl-1.1",
    "server side public license": "sspl-1.0",
    "business source license": "busl-1.1",
    "cc0 1 0 universal": "cc0-1.0",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
}
# Words that introduce an expression, what may stand between them and it,
# and whether identifiers nobody knows may occur in it.
ASSIGNED = rb"[\"']?[ \t]*[:=][ \t]*(?:\{[ \t]*text[ \t]*=[ \t]*)?[\"']?"
LED = rb"[ \t]+(?:(?:the|either|both|terms|of)[ \t]+)*"
TAGS = {
    "spdx license identifier": (ASSIGNED, True), "license expression": (ASSIGNED, True),
    "license": (ASSIGNED, False), "licence": (ASSIGNED, False), "licenses": (ASSIGNED, False),
    "licensed under": (LED, False), "released under": (LED, False),
    "distributed under": (LED, False), "available under": (LED, False),
}
# How sure a finding is.
TAG_WEIGHT, EXPRESSION_WEIGHT, NOTICE_WEIGHT = 0.95, 0.9, 0.8

UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
TO_WORDS = bytes(b if IS_WORD[b] else 32 for b in range(256)).translate(bytes.maketrans(UPPER, LOWER))


def known_licenses() -> dict[str, tuple[str, int]]:
    """Spelling in lower case: (identifier, how far it reaches)."""
    found = {name.lower(): (name, reach) for name, reach in LICENSES.items()}
    for family, (reach, versions) in GNU.items():
        for version in versions:
            for written, meant in (("", "-only"), ("-only", "-only"), ("+", "-or-later"),
                                   ("-or-later", "-or-later")):
                found[f"{family}-{version}{written}".lower()] = (f"{family}-{version}{meant}", reach)
    for family, reach in COMMONS.items():
        for version in COMMONS_VERSIONS:
            found[f"{family}-{version}".lower()] = (f"{family}-{version}", reach)
    for spelling, name in SPELLINGS.items():
        found[spelling] = found[name.lower()]
    return found


KNOWN = known_licenses()
EXEMPT = {name.lower(): name for name in EXCEPTIONS}


def label_of(name: str) -> str:
    return LABELS.get(name, name.lower())


@dataclass(frozen=True)
class Policy:
    """Licences that reach up to ``most`` are allowed; ``allow`` and ``deny`` are lists of
    identifiers that override it. What nobody knows is not allowed."""

    most: int = WEAK
    allow: frozenset[str] = frozenset()
    deny: frozenset[str] = frozenset()

    def allows(self, name: str, exempt: bool = False) -> bool:
        if name in self.allow or name in self.deny:
            return name in self.allow
        known = KNOWN.get(name.lower())
        if known is None:
            return False
        reach = known[1]
        return (WEAK if exempt and reach == STRONG else reach) <= self.most


# --- expressions -------------------------------------------------------------------

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*)")
INSIDE = re.compile(rb"[\s*#/;]*([()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*)")


def expression_tokens(data: bytes, at: int) -> list[str]:
    """The longest run of tokens from ``at`` on in which operands and operators take turns
    and that ends with an operand or a closing parenthesis. Inside of parentheses it may
    go over line ends and comment signs."""
    tokens, complete, depth, operand = [], 0, 0, True
    while found := (INSIDE if depth else TOKEN).match(data, at):
        word, at = found[1].decode(), found.end()
        if word[0] not in "()":
            kept = word.rstrip(".:_-")
            ended, word = kept != word, kept
        else:
            ended = False
        is_operator = word.lower() in PRECEDENCE
        if operand:
            if word == ")" or is_operator:
                break
            if word == "(":
                depth += 1
            else:
                operand = False
        elif word == ")":
            if not depth:
                break
            depth -= 1
        elif is_operator:
            operand = True
        else:
            break
        tokens.append(word)
        if not operand:
            complete = len(tokens)
        if ended:
            break
    return tokens[:complete]


def reverse_polish(tokens: list[str]) -> list[str]:
    """Shunting-yard; a parenthesis left open closes at the end."""
    out, waiting = [], []
    for token in tokens:
        rank = PRECEDENCE.get(token.lower())
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif rank is None:
            out.append(token)
        else:
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= rank:
                out.append(waiting.pop())
            waiting.append(token.lower())
    out += [token for token in reversed(waiting) if token != "("]
    return out


@dataclass
class Expression:
    """What an expression says: the licences it names, the parts nobody knows, whether the
    policy allows it, and the expression in one spelling."""

    labels: set[str] = field(default_factory=set)
    unknown: list[str] = field(default_factory=list)
    allowed: bool = False
    written: str = ""


def evaluate(tokens: list[str], policy: Policy) -> Expression | None:
    """None if there is no expression, or ``with`` stands elsewhere than between a licence
    and an exception."""
    result = Expression()
    stack: list[tuple[bool, list[str], int, str | None]] = []  # allowed, spelling, rank, licence
    for token in reverse_polish(tokens):
        rank = PRECEDENCE.get(token)
        if rank is None:
            name = KNOWN.get(token.lower(), (EXEMPT.get(token.lower(), token), 0))[0]
            stack.append((policy.allows(name), [name], 4, name))
            continue
        (right, right_text, right_rank, right_name), (left, left_text, left_rank, left_name) = \
            stack.pop(), stack.pop()
        if token == "with":
            if left_name is None or right_name is None:
                return None
            if right_name.lower() not in EXEMPT:
                result.unknown.append(right_name)
            allowed = policy.allows(left_name, exempt=right_name.lower() in EXEMPT)
        else:
            allowed = (left and right) if token == "and" else (left or right)
        # Pieces are linked, not joined, so that a long expression stays linear.
        text = [["(", left_text, ")"] if left_rank < rank else left_text, f" {token.upper()} ",
                ["(", right_text, ")"] if right_rank < rank else right_text]
        stack.append((allowed, text, rank, None))
        if token == "with":
            note_license(result, left_name)
        else:
            for part in (left_name, right_name):
                if part is not None:
                    note_license(result, part)
    if not stack:
        return None
    allowed, text, _, name = stack.pop()
    if name is not None:
        note_license(result, name)
    result.allowed, result.written = allowed, flattened(text)
    return result


def note_license(result: Expression, name: str) -> None:
    if name.lower() in KNOWN:
        result.labels.add(label_of(name))
    else:
        result.unknown.append(name)


def flattened(pieces: list) -> str:
    out, open_pieces = [], [pieces]
    while open_pieces:
        piece = open_pieces.pop()
        if isinstance(piece, str):
            out.append(piece)
        else:
            open_pieces.extend(reversed(piece))
    return "".join(out)


# --- texts -------------------------------------------------------------------------

@dataclass
class Automaton:
    """Phrases and tags in one automaton; ``reach`` is the longest in words."""

    machine: ahocorasick.Automaton
    kinds: list[tuple[str, str, str]]
    reach: int


def commons_notices() -> dict[str, str]:
    """Short names as words: "cc by sa 4 0"."""
    return {f"{family}-{version}".lower().replace("-", " ").replace(".", " "): f"{family}-{version}".lower()
            for family in COMMONS for version in COMMONS_VERSIONS}


def build_automaton() -> Automaton:
    """Matches include the blank before and after, so they begin and end with words."""
    kinds = [("base", phrase, label) for phrase, label in BASE_PHRASES.items()]
    kinds += [("notice", phrase, label) for phrase, label in (NOTICES | commons_notices()).items()]
    kinds += [("tag", phrase, phrase) for phrase in TAGS]
    by_phrase: dict[str, list[int]] = {}
    for number, (_, phrase, _) in enumerate(kinds):
        by_phrase.setdefault(phrase, []).append(number)
    machine = ahocorasick.Automaton()
    for phrase, numbers in by_phrase.items():
        machine.add_word(f" {phrase} ", (len(phrase) + 2, tuple(numbers)))
    machine.make_automaton()
    return Automaton(machine, kinds, max(len(phrase.split()) for phrase in by_phrase))


WORDS_ON = rb"(?:[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+){0,%d}"
SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def chunks(data: bytes, reach: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end, end of what is read): from separator to separator, and on for as many
    words as a phrase that begins in the chunk may need."""
    ahead, begin = re.compile(WORDS_ON % (reach + 1)), 0
    while begin < len(data):
        end = begin + CHUNK_BYTES
        cut = SEPARATOR.search(data, end) if end < len(data) else None
        end = cut.start() if cut else len(data)
        yield begin, end, ahead.match(data, end).end() if end < len(data) else end
        begin = end


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of all words."""
    word = IS_WORD[np.frombuffer(data, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    return edges[0::2], edges[1::2]


def places(data: bytes, automaton: Automaton) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Number of words, and all places (first word, words, kind, end in bytes)."""
    words, found = 0, []
    for begin, end, seen in chunks(data, automaton.reach):
        piece = data[begin:seen]
        starts, ends = word_spans(piece)
        own = int(np.searchsorted(starts, end - begin))
        if not len(starts):
            continue
        lowered = np.frombuffer(piece.translate(TO_WORDS), dtype=np.uint8)
        keep = np.zeros(len(piece) + 1, dtype=bool)
        keep[:-1] = lowered != 32
        keep[ends] = True
        text = " " + np.append(lowered, np.uint8(32))[keep].tobytes().decode("latin-1")
        first_at = None
        for last, (length, numbers) in automaton.machine.iter(text):
            if first_at is None:  # where each word begins in the words joined by blanks
                first_at = np.concatenate(([0], np.cumsum(ends - starts + 1)))[:-1] + 1
            word = int(np.searchsorted(first_at, last - length + 2))
            if word >= own:
                continue
            for number in numbers:
                size = automaton.kinds[number][1].count(" ") + 1
                found.append((words + word, size, number, begin + int(ends[word + size - 1])))
        words += own
    return words, found


def outermost(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Without those that lie inside a longer one."""
    out, reached = [], -1
    for place in sorted(found, key=lambda p: (p[0], -p[1])):
        if place[0] + place[1] > reached:
            out.append(place)
            reached = place[0] + place[1]
        elif out and out[-1][:2] == place[:2]:
            out.append(place)
    return out


@dataclass
class Finding:
    n_words: int
    base: list[tuple[int, str]]
    labels: set[str]
    expressions: list[Expression]
    score: float


def find_licenses(data: bytes, automaton: Automaton, policy: Policy) -> Finding:
    """All findings of one text in UTF-8."""
    n_words, found = places(data, automaton)
    of_kind: dict[str, list] = {"base": [], "notice": [], "tag": []}
    for place in found:
        of_kind[automaton.kinds[place[2]][0]].append(place)
    base = [(first, automaton.kinds[number][2]) for first, _, number, _ in of_kind["base"]]
    weights = {("notice", label): NOTICE_WEIGHT for _, label in base}
    for _, _, number, _ in outermost(of_kind["base"] + of_kind["notice"]):
        weights["notice", automaton.kinds[number][2]] = NOTICE_WEIGHT
    labels, expressions = {label for _, label in weights}, []
    for _, _, number, end in outermost(of_kind["tag"]):
        between, lenient = TAGS[automaton.kinds[number][1]]
        led = re.compile(between).match(data, end)
        tokens = expression_tokens(data, led.end()) if led else []
        said = evaluate(tokens, policy)
        if said is None or not said.labels and not lenient or said.unknown and not lenient:
            continue
        expressions.append(said)
        labels |= said.labels
        for label in said.labels:
            weights["said", label] = TAG_WEIGHT if lenient else EXPRESSION_WEIGHT
    doubt = 1.0
    for key in sorted(weights):
        doubt *= 1.0 - weights[key]
    return Finding(n_words, base, labels, expressions, 1.0 - doubt)


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, expressions string, allowed boolean")


def scan_licenses(documents: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text), as RESULT.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are about BASE_PHRASES
    alone; ``labels`` adds notices and expressions. ``expressions`` holds what was read
    after tags, in one spelling, joined by "; ". ``allowed`` says whether the policy allows
    all of them, NULL where there is none. ``score`` is one minus the product of the
    doubts of all different findings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            for part in text_batches(iter([batch]), BATCH_BYTES):
                rows = [summary(find_licenses(text or b"", automaton, policy))
                        for text in part.column(1).cast(pa.binary()).to_pylist()]
                columns = zip(*rows) if rows else [()] * len(KINDS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, kind) for c, kind in zip(columns, KINDS)]],
                    names=[part.split(" ")[0] for part in RESULT.split(", ")])

    return documents.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(run, RESULT)


KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
         pa.string(), pa.bool_())


def summary(found: Finding) -> tuple:
    at = [first for first, _ in found.base]
    return (found.n_words, len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in found.base})), ",".join(sorted(found.labels)),
            found.score, "; ".join(said.written for said in found.expressions),
            all(said.allowed for said in found.expressions) if found.expressions else None)


