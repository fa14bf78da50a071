"""Licence findings against a plain scan and hand-made cases."""

import random
import re
import time

import pytest

from tallyloom.llm import license_scan as ls

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {code: code + 32 for code in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = [(k, label) for phrase, label in ls.BASE_PHRASES.items() for k in range(len(words))
             if words[k:k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in found]
    return (len(words), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in found})))


def texts():
    rng = random.Random(5)
    parts = ["under", "the", "MIT", "license", "Apache", "License,", "Version", "2.0", "CC", "BY-NC", "4", "é",
             "Under the mit LICENSE", "cc-by-nc", "\n", "..", "über", "2\t0", "cc by", "nc", "mit\x00license"]
    out = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return [*out, None, "", " .,", "under the mit license under the mit license", "x" * 50 + " cc by nc"]


def test_base_equals_plain_scan(spark, monkeypatch):
    rows = [(k, text, "s", 0.5, "l") for k, text in enumerate(texts())]
    rows += [(None, "cc by nc", "s", 0.1, "l"), rows[3], rows[3]]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, score double, labels string")
    got = ls.scan_licenses(table.repartition(3)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)
    for row in got:
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
    assert ls.scan_licenses(table.where("false")).collect() == []


@pytest.mark.parametrize("size", [1, 7, 40])
def test_chunks_do_not_change_findings(monkeypatch, size):
    automaton = ls.build_automaton()
    whole = [ls.find_licenses((text or "").encode(), automaton, ls.Policy()) for text in texts()]
    monkeypatch.setattr(ls, "CHUNK_BYTES", size)
    cut = [ls.find_licenses((text or "").encode(), automaton, ls.Policy()) for text in texts()]
    assert [(f.n_words, sorted(f.base), f.labels, f.score) for f in whole] == [
        (f.n_words, sorted(f.base), f.labels, f.score) for f in cut]


def found(text, **policy):
    return ls.find_licenses(text.encode(), ls.build_automaton(), ls.Policy(**policy))


@pytest.mark.parametrize("text, written, allowed, labels", [
    ("// SPDX-License-Identifier: MIT", "MIT", True, {"mit"}),
    ("/* SPDX-License-Identifier: GPL-2.0+ */", "GPL-2.0-or-later", False, {"gpl-2.0-or-later"}),
    ("SPDX-License-Identifier: MIT OR GPL-3.0-only AND ISC", "MIT OR GPL-3.0-only AND ISC", True,
     {"mit", "gpl-3.0-only", "isc"}),
    ("SPDX-License-Identifier: (mit or gplv3) and isc.", "(MIT OR GPL-3.0-only) AND ISC", True,
     {"mit", "gpl-3.0-only", "isc"}),
    ("SPDX-License-Identifier: (MIT OR ISC) AND GPL-3.0", "(MIT OR ISC) AND GPL-3.0-only", False,
     {"mit", "isc", "gpl-3.0-only"}),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 OR BUSL-1.1",
     "GPL-2.0-only WITH Classpath-exception-2.0 OR BUSL-1.1", True, {"gpl-2.0-only", "busl-1.1"}),
    ("# SPDX-License-Identifier: (MIT OR\n#   Apache-2.0)\n", "MIT OR Apache-2.0", True, {"mit", "apache-2"}),
    ("SPDX-License-Identifier: MIT AND (Apache-2.0", "MIT AND Apache-2.0", True, {"mit", "apache-2"}),
    ("SPDX-License-Identifier: MIT AND", "MIT", True, {"mit"}),
    ("SPDX-License-Identifier: LicenseRef-Own", "LicenseRef-Own", False, set()),
    ('"license": "MIT OR Apache-2.0",', "MIT OR Apache-2.0", True, {"mit", "apache-2"}),
    ("license = { text = 'ISC' }", "ISC", True, {"isc"}),
    ("This is licensed under the terms of the MPL-2.0, see", "MPL-2.0", True, {"mpl-2.0"}),
    ("license: Proprietary-Thing", None, None, set()),
    ("die lizenz mit und ohne", None, None, set()),
    ("the license is mit", None, None, set()),
])
def test_expressions(text, written, allowed, labels):
    said = found(text).expressions
    assert ([e.written for e in said], [e.allowed for e in said]) == (
        ([], []) if written is None else ([written], [allowed]))
    assert found(text).labels == labels


def test_policy():
    text = "SPDX-License-Identifier: GPL-3.0-only"
    assert found(text, most=ls.STRONG).expressions[0].allowed
    assert found(text, allow=frozenset({"GPL-3.0-only"})).expressions[0].allowed
    assert not found("SPDX-License-Identifier: MIT", deny=frozenset({"MIT"})).expressions[0].allowed


def test_longest_notice_counts():
    text = "This work is licensed under the GNU General Public License, version 3."
    assert found(text).labels == {"gpl-3.0"}
    assert found("Licensed under CC BY-NC 4.0.").labels == {"cc-by-nc", "cc-by-nc-4.0"}


@pytest.mark.parametrize("text", [
    "spdx-license-identifier: (" * 40_000, "spdx-license-identifier: " + "(" * 500_000,
    "spdx-license-identifier: " + "mit or " * 150_000, "spdx-license-identifier: " + "(mit or " * 100_000,
    "licensed under " + " " * 1_000_000, "license=" * 100_000, "cc by nc " * 100_000, "x" * 9_000_000])
def test_time_is_linear(text):
    begin = time.perf_counter()
    found(text)
    assert time.perf_counter() - begin < 8
