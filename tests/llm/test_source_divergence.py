"""Divergence of sources against brute force with integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import source_divergence as sd

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {code: code + 32 for code in range(65, 91)}


def brute(rows, least, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = TERM.findall(text.translate(LOWER))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        totals = sum((counts[lang, s] for s in sources), Counter())

        def share(count):
            size = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // size for t in kept}

        def price(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: share(counts[lang, s]) for s in sources}, share(totals)
        for s in sources:
            pairs = [(sum(price(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(price(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def rows_of(seed, count):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "déjà", "x", "ß", "été", "delta", "EPS", "zeta", "eta", "θ"] + [
        f"w{chr(97 + a)}{chr(97 + b)}" for a in range(6) for b in range(6)]
    rows = []
    for _ in range(count):
        few = rng.sample(words, rng.randint(1, 20))
        text = rng.choice([" ", ", ", "7", "\n"]).join(rng.choice(few) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "fr", None, "solo"]),
                     rng.choice(["s0", "s0", "s1", "s2", "é", None, "s4"])))
    rows = [r if r[1] != "solo" else (r[0], "solo", "s0") for r in rows]
    return [*rows, ("rare words only", "xx", "a"), ("other", "xx", "b"), (None, "xx", None), ("a b", "yy", "one")]


@pytest.mark.parametrize("least, top, tile, bits", [(3, 10, 64, 12), (2, 3, 2, 2), (1, 2, 1, 1)])
def test_divergence_equals_brute_force(spark, least, top, tile, bits):
    rows = rows_of(least, 260)
    table = spark.createDataFrame([(1, *row, 5, "t") for row in rows],
                                  "doc_id long, text string, lang string, source string, value int, tile string")
    got = sd.source_divergence(table.repartition(3), least, top, tile, bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_empty_tables(spark):
    table = spark.createDataFrame([], "text string, lang string, source string")
    assert sd.source_divergence(table).collect() == []
    bare = spark.createDataFrame([(None, "l", "a"), ("", "l", "b")], "text string, lang string, source string")
    assert sorted(map(tuple, sd.source_divergence(bare).collect())) == [
        ("l", "a", "pair", "b", 0, 1), ("l", "b", "pair", "a", 0, 1)]


def test_equal_subtrees_are_one_node():
    counts = np.zeros((9, 4096), dtype=np.int64)
    counts[:, 0] = np.arange(9)
    forest = sd.grow(counts)
    assert sum(len(left) for left, _ in forest.children) == 9 * 12  # one spine each; that of zeros serves all
    left, right, times = sd.leaf_pairs(forest, 3, 4)
    assert sorted(zip(left.tolist(), right.tolist(), times.tolist())) == [(0, 0, 4095), (3, 4, 1)]
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (4, 1024))
    forest = sd.grow(counts)
    left, right, times = sd.leaf_pairs(forest, 0, 1)
    wanted = Counter(zip(counts[0].tolist(), counts[1].tolist()))
    assert {(a, b): n for a, b, n in zip(left.tolist(), right.tolist(), times.tolist())} == wanted


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "Äb c, dé\n" * 500
    whole = [t for part in sd.terms_of(text.encode()) for t in part]
    monkeypatch.setattr(sd, "CHUNK_BYTES", 7)
    assert [t for part in sd.terms_of(text.encode()) for t in part] == whole


def test_shares_pass_64_bits():
    big = 10 ** 15
    assert sd.shares(np.array([big, -1]), big, 3).tolist() == [1 + 10 ** 9 * (big + 2) // (big + 6), 1]
