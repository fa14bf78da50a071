"""Collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import collocations as co

LOWER = {code: code + 32 for code in range(65, 91)}


def brute(rows, least, most, share, top):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            for size in range(1, most + 1):
                counts[lang or "und"].update(tuple(words[k:k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        found = []
        for p, a in frequent.items():
            if any(len(o) > len(p) and 100 * n >= share * a and any(
                    o[k:k + len(p)] == p for k in range(len(o))) for o, n in frequent.items()):
                continue
            score, _, left, right = min(
                (10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        total = sum(n for p, n in f.items() if len(p) == 1)
        out += [(lang, k + 1, p.decode(), -a, left, right, total, -score)
                for k, (score, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def rows_of(seed, count=160):
    rng = random.Random(seed)
    words = ["The", "new", "york", "Été", "of", "x\x00y", "de", "ß", "a-b", "'s", "..", "na", "na"]
    joints = [" "] * 12 + ["  ", "\t", ", ", ".", "\n", "\x0b", "? "]
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice([text] * 8 + [None, ""]), rng.choice(["en", "en", "und", None, "fr"])))
    return [*rows, ("new york city " * 40, "en"), ("only once here", "xx"), ("", "empty"), ("a b " * 30, "ab")]


@pytest.mark.parametrize("least, most, share, top, small", [
    (10, 3, 50, 2000, False), (3, 4, 70, 15, True), (2, 2, 50, 5, False)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, most, share, top, small):
    if small:  # slices of few bytes, few rows held, a pass per trie
        monkeypatch.setattr(co, "CHUNK_BYTES", 9)
        monkeypatch.setattr(co, "HELD_ROWS", 20)
    rows = rows_of(least)
    table = spark.createDataFrame([(None, *r, 1, "p") for r in rows],
                                  "doc_id long, text string, lang string, n int, phrase string")
    got = co.collocations(table.repartition(3), least, most, share, top, **({"group_bytes": 1} if small else {}))
    assert sorted(map(tuple, got.collect())) == brute(rows, least, most, share, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_empty_tables(spark):
    for rows in ([], [(None, None)], [("a b", "en")]):
        assert co.collocations(spark.createDataFrame(rows, "text string, lang string")).collect() == []


@pytest.mark.parametrize("size", [2, 3])
def test_trie_accepts_its_phrases_and_no_others(size):
    rng = random.Random(size)
    words = [f"w{k}" for k in range(60)] + ["é", "ß"]
    phrases = sorted({" ".join(rng.choice(words[:3] if k % 2 else words) for _ in range(size)) for k in range(900)})
    trie, states = co.build_trie("en", pa.array(phrases))
    assert len(set(states.tolist())) == len(phrases)
    text = " ".join(rng.choice(words + ["zz"]) for _ in range(20_000)).encode()
    part = co.split_words("en", np.frombuffer(text, dtype=np.uint8), np.zeros(1, dtype=np.int64), len(text))
    got = Counter(co.advance(trie, part, size).tolist())
    said = text.decode().split()
    wanted = Counter(" ".join(said[k:k + size]) for k in range(len(said)))
    number = dict(zip(phrases, states.tolist()))
    assert got == {number[p]: n for p, n in wanted.items() if p in number}


def test_slices_cover_a_long_text(monkeypatch):
    text = ("Ab cd, ef  gh.ij " * 50).encode()
    batch = pa.record_batch([pa.array(["en"]), pa.array([text.decode()])], names=["lang", "text"])

    def phrases():
        out = []
        for part in co.slices(iter([batch]), 2):
            words, linked = part.words.take(pa.array(part.codes)).to_pylist(), part.linked()
            out += [tuple(words[k:k + 3]) for k in range(part.own)
                    if k + 2 < len(words) and linked[k] and linked[k + 1]]
        return out

    whole = phrases()
    for size in (1, 3, 10, 50):
        monkeypatch.setattr(co, "CHUNK_BYTES", size)
        assert phrases() == whole
    assert co.split_words("en", np.frombuffer(b" ,.", dtype=np.uint8), np.zeros(1, dtype=np.int64), 3) is None


def test_filters_let_all_members_pass():
    phrases = pa.array([f"{a} {b}" for a in "abcdé" for b in "xyzß"])
    hashes = co.phrase_hashes(phrases, pa.array(["en"] * len(phrases)))
    assert len(set(hashes.tolist())) == len(phrases)
    words = pa.array([w.encode() for w in "abcdé"], pa.binary())
    last = pa.array([w.encode() for w in "xyzß"], pa.binary())
    again = co.extended(np.repeat(co.word_hashes(words, "en"), 4), np.tile(co.word_hashes(last, "en"), 5))
    assert hashes.tolist() == again.tolist()
    assert set(hashes.tolist()).isdisjoint(co.phrase_hashes(phrases, pa.array(["fr"] * len(phrases))).tolist())


def test_work_does_not_grow_with_the_candidates(spark, monkeypatch):
    """Texts are read as often for one trie a phrase as for few tries, and rare phrases are
    not written, even by filters too small to tell anything."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(30)]
    rows = [(" ".join(rng.choice(words) for _ in range(12)), rng.choice(["en", "fr"])) for _ in range(240)]
    rows += [("new york. new york", lang) for lang in ("en", "fr") for _ in range(6)]
    table = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    written, found = co.written_table, []

    def recorded(some, label):
        out = written(some, label)
        found[-1].append((label, out.count()))
        return out

    monkeypatch.setattr(co, "written_table", recorded)
    monkeypatch.setattr(co, "LEAST_BITS", 6)
    monkeypatch.setattr(co, "MOST_BITS", 6)
    for group_bytes in (co.GROUP_BYTES, 1):
        found.append([])
        got = co.collocations(table, group_bytes=group_bytes)
        assert sorted(map(tuple, got.collect())) == brute(rows, 10, 3, 50, 2000)
    assert found[0] == found[1]
    assert max(count for label, count in found[0] if label != "words") <= 64


def test_hashes_of_several_tasks_are_kept_from_their_number_on(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(co, "HELD_HASHES", 500)
    hashes = co.mixed(rng.integers(0, 900, 8000, dtype=np.uint64))
    bits = co.part_bits(0)
    for least in (1, 10, 400):
        task = co.deal_task(lambda parts: iter(parts), bits, min(least, co.MOST_COUNT))
        rows = pa.Table.from_batches([b for some in np.split(hashes, 4) for b in task(np.split(some, 20))])
        kept = pa.Table.from_batches(co.keep_task(min(least, co.MOST_COUNT))(rows.sort_by("part").to_batches()))
        got = {(part << 32) + key for part, keys in zip(kept["part"].to_pylist(), kept["keys"].to_pylist())
               for key in np.frombuffer(keys, dtype=np.uint32).tolist()}
        wanted = {h >> (32 - bits) for h, n in Counter(hashes.tolist()).items() if n >= min(least, co.MOST_COUNT)}
        assert got == wanted and sum(kept["n"].to_pylist()) == len(wanted)


@pytest.mark.parametrize("size, most", [(2, 50), (3, 7), (2, 10 ** 6)])
def test_phrases_of_packs_are_counted_by_a_chain_of_tries(monkeypatch, size, most):
    monkeypatch.setattr(co, "TRIE_PHRASES", most)
    rng = random.Random(size)
    words = [f"w{k}" for k in range(9)] + ["é", "x\x00y"]
    wanted, counted = Counter(), co.Counted("en", size)
    for _ in range(30):
        pack = Counter(" ".join(rng.choice(words) for _ in range(size)) for _ in range(20))
        wanted += pack
        said = [phrase.encode() for phrase in pack]
        counted.add(np.array([len(p) for p in said], dtype=np.int32),
                    np.frombuffer(b"".join(said), dtype=np.uint8), np.array(list(pack.values())))
    for least in (1, 6):
        got = [row for batch in counted.frequent(least) for row in batch.to_pylist()]
        assert {row["phrase"]: row["n"] for row in got} == {p: n for p, n in wanted.items() if n >= least}
        assert len(got) == len({row["phrase"] for row in got}) and {row["lang"] for row in got} <= {"en"}
    assert (len(counted.tries) > 1) == (most < 1000)


@pytest.mark.parametrize("symbols, parents", [(4, 9), (64, 300), (256, 2000)])
def test_children_get_states_of_their_own(symbols, parents):
    rng = np.random.default_rng(symbols)
    sets = [np.sort(rng.choice(symbols, min(symbols, int(rng.zipf(1.5))), replace=False)) for _ in range(parents)]
    base, check = np.zeros(2 * symbols + parents, dtype=np.int32), np.full(2 * symbols + parents, -1, dtype=np.int32)
    check[:parents] = -2
    owner, children = np.repeat(np.arange(parents), [len(s) for s in sets]), np.concatenate(sets)
    state, base, check = co.place_children(owner, children, symbols, base, check, rng)
    assert len(set(state.tolist())) == len(state) and (state >= parents).all()
    assert (check[state] == owner).all() and (base[owner] + children == state).all()
    assert base[:parents].min() >= 1 and base.max() + symbols <= len(base)
    assert (check >= 0).sum() == len(state)
