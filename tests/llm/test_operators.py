"""The operators against brute force and hand-made cases."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import (
    decontaminate, html_render, language_id, minhash_dedup, packing, rule_ensemble, secret_scan,
    suffix_dedup, topk_search, warc,
)
from tallyloom.llm.common import tokenizer_path

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "ré") for b in ("ne", "sa", "vo", "ß", "do")]


def prose(rng, count):
    return " ".join(rng.choice(WORDS) for _ in range(count))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = [prose(rng, 90) for _ in range(6)]
    passage = prose(rng, 60)
    texts = [*base, base[0], base[0], base[1].replace("ka", "KA", 1), None, "", "one", "  ", "kane kane", "kane kane"]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(5)]
    texts += [base[2] + " " + base[2], "kane " * 300, base[3][:-40] + prose(rng, 5)]
    return list(enumerate(texts)) + [(None, base[4]), (3, prose(rng, 50))]


def documents(spark, rows):
    table = spark.createDataFrame(
        [(d, t, "x", "s", 1) for d, t in rows], "doc_id long, text string, shingles string, node string, hash int")
    return table.repartition(3)


def brute_passages(rows):
    def key(row):
        data = (row[1] or "").encode()
        return (suffix_dedup.NULL_ID if row[0] is None else row[0], suffix_dedup.text_tie(data))

    seen, out = set(), []
    for number, text in sorted(rows, key=key):
        data, gone = (text or "").encode(), set()
        for s in range(len(data) - 99):
            if data[s:s + 100] in seen:
                gone |= set(range(s, s + 100))
            seen.add(data[s:s + 100])
        left = bytes(b for k, b in enumerate(data) if k not in gone)
        out.append((number, len(data), len(gone), sum(k - 1 not in gone for k in gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [(64, 4096), (1, 2)])
def test_passages_equal_brute_force(spark, rows, monkeypatch, limits):
    monkeypatch.setattr(suffix_dedup, "CROWDED_IN_FLUSH", limits[0])
    monkeypatch.setattr(suffix_dedup, "CROWDED", limits[1])
    got = suffix_dedup.dedup_passages(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_passages(rows)


@pytest.mark.parametrize("flush", [24 << 20, 100])
@pytest.mark.parametrize("limits", [(64, 4096), (1, 2)])
def test_repeated_rows_are_one_document(spark, rows, monkeypatch, limits, flush):
    monkeypatch.setattr(suffix_dedup, "CROWDED_IN_FLUSH", limits[0])
    monkeypatch.setattr(suffix_dedup, "CROWDED", limits[1])
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", flush)
    again = [rows[3], rows[3], rows[20], rows[20], rows[18], rows[9], rows[-2], rows[-1]]
    once = {r[:2]: r for r in brute_passages(rows)}  # rows with one id differ in size here
    wanted = [once[number, len((text or "").encode())] for number, text in rows + again]
    got = suffix_dedup.dedup_passages(documents(spark, rows + again)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_run_length_index_finds_first_windows():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(100, 300))) for _ in range(8)]
    texts += [texts[0], texts[1][20:150], b"a" * 250]
    sizes = np.array([len(t) for t in texts])
    seen, wanted = set(), []
    for text in texts:
        for s in range(len(text) - 99):
            wanted.append(text[s:s + 100] not in seen)
            seen.add(text[s:s + 100])
    assert suffix_dedup.first_windows(b"".join(texts), sizes).tolist() == wanted


def shingle_set(text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute_near(rows):
    ids = [minhash_dedup.NULL_ID if d is None else d for d, _ in rows]
    sets = [shingle_set(t) for _, t in rows]
    found = minhash_dedup.UnionFind()
    for i in range(len(rows)):
        found.find(ids[i])
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                found.join(ids[i], ids[j])
    back = lambda n: None if n == minhash_dedup.NULL_ID else n
    return sorted([(d, len(s), back(found.find(n)), found.find(n) == n) for (d, _), n, s in zip(rows, ids, sets)], key=repr)


@pytest.mark.parametrize("block", [500_000, 200])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, rows, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", block)
    rng = random.Random(5)
    base = prose(rng, 120).split(" ")
    copies = []
    for k in range(12):  # independent edits: some pairs fall below the threshold
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(len(words))] = "edited"
        copies.append((100 + k, " ".join(words)))
    table = rows[:-1] + copies
    got = minhash_dedup.near_duplicates(documents(spark, table)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_near(table)


def chain(order, shift=10, size=104):
    """Documents that are windows over one sequence of words, ids rising in the order."""
    return [(k, " ".join(f"w{j}" for j in range(shift * at, shift * at + size))) for k, at in enumerate(order)]


def test_near_duplicates_of_a_chain(spark):
    table = chain([1, 2, 5, 4, 3, 0, 6])
    got = minhash_dedup.near_duplicates(documents(spark, table)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_near(table)
    assert {r["component_id"] for r in got} == {0}


@pytest.mark.parametrize("crossing", [False, True])
def test_links_span_groups_that_grow(crossing):
    rng = random.Random(11)
    for _ in range(300):
        order = [at + gap for gap in (0, 40) for at in range(rng.randint(2, 12))]
        rng.shuffle(order)
        sets = [np.arange(10 * at, 10 * at + rng.choice([98, 100, 102]), dtype=np.uint64) for at in order]
        side = np.array([rng.randint(0, 1) for _ in sets])
        wanted, found = minhash_dedup.UnionFind(), minhash_dedup.UnionFind()
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                near = 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common)
                if near and (not crossing or side[i] != side[j]):
                    wanted.join(i, j)
        links = minhash_dedup.spanning_links(sets, side, crossing)
        assert all(found.join(a, b) for a, b in links)
        assert [found.find(k) for k in range(len(sets))] == [wanted.find(k) for k in range(len(sets))]


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, 100), (200, 150)]
    random.Random(1).shuffle(edges)
    table = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r["node"]: r["root"] for r in minhash_dedup.components(table).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {150: 100, 200: 100}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    one, other = np.unique(pool[:300]), np.unique(pool[100:])
    signed = minhash_dedup.signatures([one, other, one])
    assert (signed[0] == signed[2]).all()
    assert abs((signed[0] == signed[1]).mean() - 0.5) < 0.15


def test_languages(spark):
    rng = random.Random(2)
    kinds = {"aa": "the of and ing tion", "bb": "der und ein sch ung", "cc": "les que aux ment é"}
    rows = [(k, " ".join(rng.choice(kinds[lang].split()) for _ in range(20)), lang)
            for k, lang in enumerate(sorted(kinds) * 40)]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "123 !!", "bb"), (903, "und der", None), (None, "the of", "aa")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify_languages(table).collect()}
    held = [got[k] for k, _, _ in rows[:120] if got[k]["held_out"]]
    assert held and all(r["lang_pred"] == sorted(kinds)[r["doc_id"] % 3] for r in held)
    assert [got[k]["lang_pred"] for k in (900, 901, 902, 903)] == ["und", "und", "und", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    empty = language_id.identify_languages(table.limit(0))
    assert empty.count() == 0


def test_encoder_equals_tokenizer():
    encoder, rng = packing.Encoder(tokenizer_path()), random.Random(1)
    pieces = [" ", "  ", "\n", "\t", "The", "é", "12", "!", "'s", " ", "　", "²", "_", "\r\n", "日本", "\0", "<|endoftext|>"]
    for _ in range(500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        wanted = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == wanted, text


def test_packing(spark, rows, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 200)
    rng = random.Random(4)
    table = [(d, t) for d, t in rows if d is not None][:-1] + [(500 + k, prose(rng, rng.randint(1, 700))) for k in range(150)]
    got = packing.pack_documents(documents(spark, table), tokenizer_path()).collect()
    encoder, by_doc, by_bin = packing.Encoder(tokenizer_path()), {}, {}
    for row in got:
        by_doc.setdefault(row["doc_id"], []).append(row)
        by_bin.setdefault(row["sequence_id"], []).append(row)
    for number, text in table:
        ids = encoder.ids(text or "") + (2).to_bytes(4, "little")
        pieces = sorted(by_doc[number], key=lambda r: r["piece"])
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in pieces] == packing.pieces_of(ids)
    for pieces in by_bin.values():
        at = 0
        for row in sorted(pieces, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= 1024
    bound = packing.bin_bound(np.array([r["length"] for r in got]))
    assert bound <= len(by_bin) <= bound * 1.03 + 1


def test_bin_bound():
    assert packing.bin_bound(np.array([600, 600, 600])) == 3
    assert packing.bin_bound(np.array([342, 342, 342])) == 2
    assert packing.bin_bound(np.array([1024, 1, 1])) == 2


def test_secret_spans():
    found = secret_scan.secret_spans
    assert found(None) == ([], []) and found("") == ([], [])
    assert found("token=short") == ([], [])
    assert found('API_KEY: "abcdefgh"')[0] == [("assign", 0, 18)]
    assert found("ſecret=abcdefghij")[0] == []
    assert found("AKIA" + "A" * 12)[0] == [("access", 0, 16)] and found("AKIA" + "A" * 11)[0] == []
    assert found("x" + "0" * 32)[0] == [("hex", 1, 33)]
    text = 'aws_key = "AbC123xyzQ"\npassword = aws_key\n'
    assert found(text)[1] == [("literal", 11, 21)]
    assert found("private_key = ${KEY_FROM_VAULT}")[1] == []
    assert found("name = 'AbC123xyzQ'")[1] == []


@pytest.mark.parametrize("line, value", [
    ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCY", "wJalrXUtnFEMI/K7MDENG/bPxRfiCY"),
    ("SIGNING_KEY=abcDEF123+ghiJKL456/xyz", "abcDEF123+ghiJKL456/xyz"),
    ("SIGNING_KEY=abcDEF123+ghiJKL456", "abcDEF123+ghiJKL456"),
    ("private_key: abcd-1234-efgh-5678", "abcd-1234-efgh-5678"),
    ("  private_key: abcDEF12==ghi= # note", "abcDEF12==ghi="),
    ("signing_key = A1b2C3d4/x, next", "A1b2C3d4/x"),
    ("url=http://h/p?signing_key=abcDEF123xyz&page=2", "abcDEF123xyz"),
    ("x=y:signing_key=abcDEF123+xyz", "abcDEF123+xyz"),
    ('PART = "AbC123xyzQ"\nprivate_key = PART+PART', "AbC123xyzQ"),
    ('private_key = prefix+"AbC123xyzQ"', "AbC123xyzQ"),
])
def test_unquoted_values_are_whole(line, value):
    start = line.index(value)
    assert secret_scan.secret_spans(line)[1] == [("literal", start, start + len(value))]


def test_secrets_of_any_length():
    rng = random.Random(12)
    blob = "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(100_000)).replace("0123", "01+23")
    wanted = {f'private_key = "{blob}"': 1, f"PRIVATE_KEY={blob}": 1}
    lines = [blob[k:k + 64] for k in range(0, 6400, 64)]
    wanted['k = "' + '" + "'.join(lines) + '"\nprivate_key = k'] = 100
    wanted["\n".join(['k = ""', *(f'k = k + "{line}"' for line in lines), "private_key = k"])] = 100
    wanted["k = 'AbC123xyzQ'\n" + "k = k + k\n" * 2000 + "private_key = k"] = 1
    wanted[f'{{"{"a" * 90}_private_key": "AbC123xyzQ"}}'] = 1
    wanted[f'x["{"a" * 70}_private_key"] = "AbC123xyzQ"'] = 1
    for text, count in wanted.items():
        found = [span for span in secret_scan.secret_spans(text)[1] if span[0] == "literal"]
        assert len(found) == count, text[:60]
    assert secret_scan.secret_spans(next(iter(wanted)))[1] == [("literal", 15, 15 + len(blob))]


@pytest.mark.parametrize("parts", [
    ["${", "KEY_123456"], ["$", "{KEY_123456}"], ["<Key12", "3456>"], ["your-", "Key123456"], ["xxxx", "XXXX"],
    ["plain words", " only here"], ["plain", "wordsonly"], ["AbC1", "23xyzQ"], ["....", "....."], ["changeme", ""],
])
def test_joined_values_score_like_their_text(parts):
    values = [secret_scan.Value(part) for part in parts]
    joined, whole = secret_scan.Value.of(values), secret_scan.Value("".join(parts))
    assert joined.literal_score() == pytest.approx(whole.literal_score())
    assert joined.placeholder() == whole.placeholder()


def test_scan_and_mask(spark):
    table = spark.createDataFrame([(1, "see token = abcdefgh1 ok", 9), (2, None, None), (3, "clean", 5)],
                                  "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in secret_scan.scan_secrets(table).collect()}
    assert got[1]["spans"] == "assign:4:21" and got[2]["spans"] == ""
    assert got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, secret_scan.mask_secrets(table).collect())) == [
        (1, "see [secret] ok", 15), (2, None, None), (3, "clean", 5)]


def test_contamination(spark, rows):
    rng = random.Random(9)
    item = prose(rng, 30)
    words = item.split(" ")
    docs = [(1, prose(rng, 200) + " " + item.replace("k", "K") + " " + prose(rng, 50)),
            (2, prose(rng, 50) + " " + " ".join(words[:24]) + " " + prose(rng, 50)),
            (3, " ".join(words[:15])), (4, None), (5, "Short item"), (None, item), (6, " ")]
    items = spark.createDataFrame([(7, item), (8, "short  ITEM"), (9, None), (10, "")], "item_id long, text string")
    got = decontaminate.contaminated(documents(spark, docs), items).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, 7, 26, 26), (2, 7, 26, 20), (5, 8, 1, 1), (None, 7, 26, 26)], key=repr)
    left = decontaminate.without_contaminated(documents(spark, docs), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 6]
    assert decontaminate.contaminated(documents(spark, docs), items.limit(0)).count() == 0


def test_rules(spark):
    rng = random.Random(6)
    rows = [(k, "<<%%>> !! " * 20 if k % 4 == 0 else prose(rng, 60), 0 if k % 4 == 0 else 1) for k in range(300)]
    table = spark.createDataFrame([*rows, (None, None, None), (999, "", None)], "doc_id long, text string, quality int")
    got = {r["doc_id"]: r for r in rule_ensemble.score_quality(table.drop("quality"), table.drop("text")).collect()}
    assert all(got[k]["predicted"] == quality for k, _, quality in rows)
    assert 0 <= got[999]["score"] <= 1 and got[None]["held_out"] is False
    none = rule_ensemble.score_quality(table.drop("quality"), table.drop("text").limit(0)).collect()
    assert {round(r["score"], 6) for r in none} == {0.5}


def test_html_rendering(spark):
    page = ("<title>x</title><h1>Head</h1><p>One<p>Two <b>bold</b>\n more<div hidden>no</div>"
            "<ul><li>a<li>b<ol><li>x<li>y</ol><li>c</ul><table><tr><th>Name<th>N<tr><td>Apples<td>3</table>"
            "<pre>\n a\n  b</pre>end &amp; &lt;done&gt;<br>next<script>var x='</p>'</script>"
            "<p style='color:red; display: none'>gone</p><details><summary>S</summary>closed</details>")
    assert html_render.rendered(page) == (
        "Head\n\nOne\n\nTwo bold more\n\n- a\n- b\n  1. x\n  2. y\n- c\n\nName    N\nApples  3\n\n a\n  b\n\n"
        "end & <done>\nnext\nS")
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000 + "<a <b"
    assert html_render.rendered(deep).startswith("deep")
    table = spark.createDataFrame([(1, None), (2, ""), (3, "<p>a</p><p>b")], "page_id long, html string")
    assert sorted(map(tuple, html_render.render_pages(table).collect())) == [(1, "", 0), (2, "", 0), (3, "a\n\nb", 2)]


@pytest.mark.parametrize("page, text", [
    ("<p>Sum <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> is", "Sum x+1 is"),
    ("<p>a <svg><title>t</title><desc/><defs><text>d</text></defs><path d='M0'/><text>L1</text><text>L2</text>"
     "<style>q</style></svg> b</p>", "a\nL1\nL2\nb"),
    ("<p>a <svg><path d='M0'/></svg> b</p>", "a b"),
    ("<select><option>One<option hidden>no<optgroup label=G><option>Two<option label=Three></select>",
     "One\nG\nTwo\nThree"),
    ("<desc>seen</desc>", "seen"),
    ("<table><tr><td rowspan=2>A<td>B<td>C<tr><td>D<td>E<tr><td>F<td>G</table>", "A  B  C\n   D  E\nF  G"),
    ("<table><tr><td>A<td rowspan=0>B<td>C<tr><td>D<td>E<tr><td>F<td>G</table>", "A  B  C\nD     E\nF     G"),
    ("<table><thead><tr><td rowspan=9>A<td>B<tbody><tr><td>C<td>D</table>", "A  B\nC  D"),
])
def test_visible_text_is_whole(page, text):
    assert html_render.rendered(page) == text


@pytest.mark.parametrize("depth", [0, 100, 195, 196, 197, 198, 199, 200, 201, 5000])
def test_hidden_text_below_depth_stays_hidden(depth):
    inside = ("a<script>no</script><style>no</style><b hidden>no<i>no</i></b><p style='display:none'>no<p>b"
              "<details>no<summary>c</summary>no</details><details open>d</details><u>e</u>")
    page = "<div hidden>" + "<div>" * depth + inside + "</div>" * depth + "no</div>end"
    assert html_render.rendered(page) == "end"
    page = "<div>" * depth + inside + "</div>" * depth + "end"
    assert "".join(html_render.rendered(page).split()) == "abcdeend"


def test_archives(spark, new_path, monkeypatch):
    long = "<p>é</p>" * 200
    rows = [(1, "http://a/1", long), (2, "http://a/2\r\nX: y", long), (3, None, "x"), (4, "http://a/4", None),
            (5, "http://a/5", "x"), (None, "http://a/6", long), (7, "http://a/7", "\r\n\r\nWARC/1.1\r\n" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    index = warc.archive_pages(pages, new_path)
    key = ("file", "offset")
    again = warc.index_archives(spark, new_path).collect()
    made = [(r["file"], r["offset"], r["length"], r["digest"], r["page_id"], r["record_type"]) for r in index.collect()]
    assert sorted(made) == sorted(
        (r["file"], r["offset"], r["length"], r["digest"], r["page_id"], r["record_type"]) for r in again), key
    monkeypatch.setattr(warc, "READ_BYTES", 300)
    got = {r["page_id"]: r for r in warc.read_records(index, new_path, with_payload=True).collect()}
    for number, _, html in rows:
        data = (html or "").encode()
        assert got[number]["payload_bytes"] == len(data)
        assert got[number]["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert bytes(got[number]["payload"]) == (b"" if number in (1, None) else data)
    assert [got[k]["refers_to"] for k in (1, 2, None, 3, 5)] == [2, None, 2, None, None]
    one = warc.read_records(index.where("page_id = 7"), new_path).collect()
    assert [r["page_id"] for r in one] == [7]


def test_search_equals_exhaustive_scores(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_DOCS", 40)
    monkeypatch.setattr(topk_search, "BLOCK", 4)
    monkeypatch.setattr(topk_search, "RARE", 4)
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randint(0, 60))) for k in range(200)] + [(200, None), (201, "Kané-SA!kané"), (None, "kane")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = docs.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    got = sorted(tuple(r) for r in topk_search.search(docs, queries, 5).collect())
    terms = {d: [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
             for d, t in rows if d is not None}
    mean = sum(map(len, terms.values())) / len(terms)
    df = {w: sum(w in t for t in map(set, terms.values())) for t in terms.values() for w in t}
    wanted = []
    for query in range(0, 201, 20):
        scores = []
        for doc, words in terms.items():
            total = 0.0
            for word in set(terms[query]) & set(words):
                tf = words.count(word)
                total += np.log1p((len(terms) - df[word] + 0.5) / (df[word] + 0.5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
            if total:
                scores.append((-round(total, 4), doc))
        wanted += [(query, k + 1, doc, -score) for k, (score, doc) in enumerate(sorted(scores)[:5])]
    assert [r[:3] for r in got] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in got], [r[3] for r in wanted], atol=2e-4)


def kinds_of_documents(size=300):
    """Documents of two kinds in turns, which share one widespread word."""
    rng = random.Random(5)
    words = [[f"{kind}{k}" for k in range(60)] for kind in "ab"]
    return [(k, " ".join(["of", f"{'ab'[k % 2]}common", *rng.choices(words[k % 2], k=25)])) for k in range(size)]


def test_shards_put_like_documents_together(monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 10)
    ids, texts = zip(*kinds_of_documents())
    batch = pa.record_batch([pa.array(ids), pa.array([t.encode() for t in texts])], names=["doc_id", "text"])
    (shard,) = [row for found in topk_search.index_task(iter([batch])) for row in found.to_pylist()]
    docs = np.frombuffer(shard["docs"], np.int64)
    assert sorted(docs.tolist()) == list(ids)
    assert all(len(set((docs[k:k + 10] % 2).tolist())) == 1 for k in range(0, len(docs), 10))


def test_search_skips_blocks_of_another_kind(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 10)
    docs = spark.createDataFrame(kinds_of_documents(), "doc_id long, text string").coalesce(1)
    index = [row for found in topk_search.index_task(iter(
        docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text").toArrow().to_batches())) for row in found.to_pylist()]
    shard = topk_search.Shard(index[0], 27.0)
    own = topk_search.word_hashes([docs.first()["text"].encode()], topk_search.SEPARATORS)[0]
    place = shard.terms.searchsorted(np.unique(own))
    idf = np.log1p((300 - shard.df[place] + 0.5) / (shard.df[place] + 0.5))
    queries = topk_search.Queries([pa.RecordBatch.from_arrays(
        [pa.array([0]), pa.array([shard.terms[place].view(np.int64)]), pa.array([idf])], names=["query_id", "terms", "idf"])])
    scored = []
    add = topk_search.Shard.add_frequent
    monkeypatch.setattr(topk_search.Shard, "add_frequent",
                        lambda self, block, *rest: (scored.append(block), add(self, block, *rest)))
    bests = topk_search.Bests(1, 10)
    shard.search(queries, bests)
    assert bests.docs[0, 0] == 0 and 0 < len(scored) <= 15
    assert not (shard.docs[np.concatenate([np.arange(10 * b, 10 * b + 10) for b in scored])] % 2).any()


def test_search_is_the_same_in_steps_of_any_size(spark, monkeypatch, new_path):
    monkeypatch.setattr(topk_search, "scratch_path", lambda *_: new_path)
    rng = random.Random(9)
    rows = kinds_of_documents(400) + [(k, prose(rng, rng.randint(0, 80))) for k in range(400, 600)]
    rows += [(k, rows[7][1]) for k in range(600, 640)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    queries = docs.where("doc_id % 7 = 0").withColumnRenamed("doc_id", "query_id")
    whole = sorted(topk_search.search(docs, queries, 5).collect())
    index = topk_search.index_task(iter(docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text").toArrow().to_batches()))
    (shard,) = [row for found in index for row in found.to_pylist()]
    batch = pa.RecordBatch.from_pylist([shard])
    mean = float(np.frombuffer(shard["lengths"], np.int64).mean())
    for name, value in [("BLOCK", 7), ("QUERIES", 3), ("PAIRS", 50), ("CELLS", 900), ("TERMS", 2), ("STEP", 100), ("LEAST", 1)]:
        monkeypatch.setattr(topk_search, name, value)
    search = topk_search.search_task(f"file://{new_path}", mean, 5)
    found = [row for got in search(iter([batch])) for row in got.to_pylist()]
    found.sort(key=lambda r: (r["query_id"], -r["score"], r["doc_id"]))
    assert [tuple(r.values()) for r in found] == [(r["query_id"], r["doc_id"], r["score"]) for r in whole]


@pytest.mark.parametrize("name", ["passages", "near", "secrets", "packing", "search", "html", "warc", "quality"])
def test_empty_tables(spark, name):
    docs = spark.createDataFrame([], "doc_id long, text string, quality int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    run = {
        "passages": lambda: suffix_dedup.dedup_passages(docs), "near": lambda: minhash_dedup.near_duplicates(docs),
        "secrets": lambda: secret_scan.scan_secrets(docs),
        "packing": lambda: packing.pack_documents(docs, tokenizer_path()),
        "search": lambda: topk_search.search(docs, docs.withColumnRenamed("doc_id", "query_id")),
        "html": lambda: html_render.render_pages(pages), "warc": lambda: warc.archived_and_read(pages),
        "quality": lambda: rule_ensemble.score_quality(docs, docs),
    }
    assert run[name]().count() == 0


@pytest.mark.parametrize("text", ["a-" * 500_000, "a." * 500_000, "a::b->" * 200_000, "a[\"k\"]" * 150_000,
                                  "password" * 100_000, "token " * 150_000, "= " * 400_000])
def test_long_names_take_linear_time(text):
    begin = time.perf_counter()
    secret_scan.secret_spans(text)
    assert time.perf_counter() - begin < 10


def test_a_long_name_keeps_its_value():
    text = "my." * 50_000 + "signing_key = 'abcd1234EFGH5678'"
    assert secret_scan.secret_spans(text)[1] == [("literal", text.index("'") + 1, len(text) - 1)]


@pytest.mark.parametrize("page", ["a <!-- " * 100_000, "<p>" * 50_000, "<b>x" * 50_000])
def test_pages_without_ends_take_linear_time(page):
    begin = time.perf_counter()
    html_render.rendered(page)
    assert time.perf_counter() - begin < 10
