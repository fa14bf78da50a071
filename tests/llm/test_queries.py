"""The queries without SQL, run as they are registered, against plain Python."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallyloom.llm import license_scan

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
LOWER = {code: code + 32 for code in range(65, 91)}


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents():
    return {key: (text or "", lang) for key, text, lang in table("documents", "doc_id, text, lang")}


def rows(spark, name):
    return contract.queries()[name](spark, FOLDER).collect()


def shingles(text):
    words = re.findall("[^\x20\x09-\x0D]+", text.translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def test_near_duplicates(spark, documents):
    sets = {key: shingles(text) for key, (text, _) in documents.items()}
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    keys = sorted(sets)
    for k, a in enumerate(keys):
        for b in keys[k + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows(spark, "op7_near_dedup")}
    assert got == {(key, len(sets[key]), find(key), find(key) == key) for key in keys}


def test_secrets(spark, documents):
    kinds = {"assign": (re.compile("(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                                   re.ASCII), 2, 8),
             "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16), "hex": (re.compile("[0-9a-f]+"), 0, 32)}
    for row in rows(spark, "op8_secret_scan"):
        text, spans = documents[row.doc_id][0], []
        for order, (kind, (pattern, group, least)) in enumerate(kinds.items()):
            spans += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text)
                      if len(m[group]) >= least]
        base = [span for *_, span in sorted(spans)]
        counts = [sum(span.startswith(kind) for span in base) for kind in kinds]
        assert [row.n_assign, row.n_access, row.n_hex] == counts
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(row.spans.split(","))


def test_licenses(spark, documents):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = rows(spark, "op11_license_scan")
    assert len(got) == len(documents)
    for row in got:
        words = word.findall(documents[row.doc_id][0].translate(LOWER))
        found = [(k, label) for phrase, label in license_scan.BASE_PHRASES.items() for k in range(len(words))
                 if words[k:k + len(phrase.split())] == phrase.split()]
        assert (row.n_words, row.n_base) == (len(words), len(found))
        assert row.base_labels == ",".join(sorted({label for _, label in found}))
        if found:
            assert (row.first_word, row.last_word) == (min(found)[0], max(found)[0]) and row.score > 0


def test_languages_and_quality_on_held_out_rows(spark, documents):
    right = [r.lang_pred == documents[r.doc_id][1] for r in rows(spark, "op9_language_id")
             if r.held_out and r.lang_pred != "und"]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    labels = dict(table("labels", "doc_id, quality"))
    got = [r for r in rows(spark, "op5_rule_ensemble") if r.held_out and labels.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    good = [r.score for r in got if labels[r.doc_id] == 1]
    bad = [r.score for r in got if labels[r.doc_id] == 0]
    assert good and bad and sum(a > b for a in good for b in bad) >= 0.9 * len(good) * len(bad)


def sequences_are_gapless(pieces):
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for found in by_sequence.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 1024
    return len(by_sequence)


def test_packing(spark, documents):
    pieces = rows(spark, "op10_packing")
    number = sequences_are_gapless(pieces)
    assert {r.doc_id for r in pieces} == set(documents)
    assert number <= 1.02 * sum(r.length for r in pieces) / 1024 + 1


def test_html_and_passages_give_a_row_each(spark, documents):
    assert len(rows(spark, "op4_html_render")) == len(table("pages", "page_id"))
    got = rows(spark, "op3_suffix_dedup")
    assert {r.doc_id for r in got} == set(documents)
    assert all(r.n_bytes == len(documents[r.doc_id][0].encode()) for r in got)


def test_pipeline(spark, documents):
    """Each stage on what the one before it kept."""
    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER).select(*columns).toPandas()
        seen[name] = dict(zip(kept["doc_id"], kept["text"]))
        assert kept["doc_id"].is_unique
        docs = spark.createDataFrame(kept, docs.schema)
    assert all(any(ch.isalpha() for ch in text) for text in seen["language_id"].values())
    left = {key: shingles(text or "") for key, text in seen["near_dedup"].items()}
    keys = sorted(left)
    for k, a in enumerate(keys):
        for b in keys[k + 1:]:
            common = len(left[a] & left[b])
            assert not left[a] or not left[b] or 100 * common < 75 * (len(left[a]) + len(left[b]) - common)
    items = [shingles(text) for _, text in table("benchmark", "item_id, text")]
    for key, text in seen["near_dedup"].items():
        hit = any(item and 100 * len(item & left[key]) >= 75 * len(item) for item in items)
        assert (key in seen["decontamination"]) == (not hit)
    assert seen["secret_scan"].keys() == seen["decontamination"].keys()
    assert not any(re.search("AKIA[A-Z0-9]{12}", text or "") for text in seen["secret_scan"].values())
    pieces = rows(spark, "pipeline")
    sequences_are_gapless(pieces)
    assert {r.doc_id for r in pieces} == seen["secret_scan"].keys()
