"""Operators that SQL cannot express, against plain programs on the given tables and on planted cases."""

import hashlib
import html
import os
import random
import re
import time
from collections import Counter

import pytest

import corpus_pipeline
from panelweave.llm import decontam, html_text, mixing, ngram_join, pii, suffix_dedup
from panelweave.llm.queries import QUERIES
from panelweave.llm.suffix_array import common_prefixes, suffix_array

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string"


def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


# --- n-gram join

def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def joined_by_hand(docs):
    sets = {i: shingle_set(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in docs}


def join_of(spark, docs):
    found = ngram_join.similarity_classes(spark.createDataFrame(list(docs.items()), DOC))
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}


@given
def test_join_on_given_documents(spark):
    docs = texts(spark)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_ngram_join"](spark, FOLDER).collect()}
    assert found == joined_by_hand(docs)


def test_join_of_chains_large_groups_and_a_common_passage(spark):
    rng = random.Random(3)
    passage = prose(rng, 40)
    docs = {i: f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for i in range(60)}  # share a passage, link with nothing
    base = prose(rng, 120).split()
    for i in range(100, 250):  # near copies, linked by some paths only
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = "zz" + str(rng.random())[2:8]
        docs[i] = " ".join(words).upper() if i % 3 else " ".join(words)
    chain = prose(rng, 60).split()
    for i in range(300, 320):  # each links with the next only
        docs[i] = " ".join(chain[i - 300:] + [f"y{k}" for k in range(i - 300)])
    docs |= {400: "one two", 401: "One  two", 402: "", 403: None, 404: "one two three", 405: prose(rng, 5000)}
    docs[406] = docs[405] + " more"
    assert join_of(spark, docs) == joined_by_hand(docs)


# --- suffix dedup

def removed_by_hand(docs):
    seen, out = set(), {}
    for key in sorted({k for k, _ in docs}):
        fresh = set()
        for text in [t for k, t in docs if k == key]:
            data = (text or "").encode()
            cut = bytearray(len(data))
            for i in range(len(data) - 49):
                if data[i:i + 50] in seen:
                    cut[i:i + 50] = b"\1" * 50
                fresh.add(data[i:i + 50])
            kept = bytes(c for c, gone in zip(data, cut) if not gone)
            runs = sum(1 for i in range(len(data)) if cut[i] and not (i and cut[i - 1]))
            out.setdefault(key, []).append((len(data), sum(cut), runs, hashlib.sha256(kept).hexdigest()))
        seen |= fresh
    return {k: sorted(v) for k, v in out.items()}


def removed_of(frame, **options):
    out = {}
    for r in suffix_dedup.remove_repeats(frame, **options).collect():
        out.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


@given
@pytest.mark.parametrize("frequent", [1, 128])
def test_repeats_in_given_documents(spark, frequent):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    assert removed_of(docs, frequent=frequent) == removed_by_hand(list(texts(spark).items()))


@pytest.mark.parametrize("frequent", [2, 128])
def test_repeats_planted(spark, frequent):
    rng = random.Random(5)
    common = prose(rng, 30)
    docs = [(i, prose(rng, rng.randint(0, 40)) + common[rng.randint(0, 20):] + prose(rng, 10)) for i in range(40)]
    docs += [(50, "a" * 500), (51, "b" + "a" * 120), (52, "ab" * 300), (53, "é" * 60), (54, "x" + "é" * 26), (55, None), (56, ""), (57, "short")]
    docs += [(60, docs[3][1]), (61, docs[3][1]), (61, docs[3][1]), (5, prose(rng, 80)), (62, "short"), (63, common[:49]), (64, common[:50])]
    docs += [(70, prose(rng, 20_000)), (71, "new start " + prose(rng, 100))]
    docs += [(72, docs[-2][1][5000:5400] + " and on")]
    assert removed_of(spark.createDataFrame(docs, DOC), frequent=frequent) == removed_by_hand(docs)


def test_suffix_array_and_common_prefixes():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        text = bytes(rng.randrange(rng.choice([1, 2, 4, 255])) for _ in range(rng.randint(1, 80)))
        data = np.frombuffer(text, dtype=np.uint8)
        order = suffix_array(data)
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        shared = common_prefixes(data, order, np.arange(len(text), 0, -1))
        for a, b in zip(want, want[1:]):
            assert shared[b] == len(os.path.commonprefix([text[a:], text[b:]]))


# --- decontamination

@given
def test_leaks_of_given_documents(spark):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op7_decontamination"](spark, FOLDER).collect()}
    exact = {(d, i) for d, t in texts(spark).items() for i, b in items.items() if len(b) >= decontam.MIN_CHARS and b in t}
    assert exact <= set(found)
    assert all(found[k] == 0 for k in exact)


def edited(rng, text, n):
    letters = list(text)
    for _ in range(n):
        at = rng.randrange(len(letters))
        rng.choice([lambda: letters.__setitem__(at, "q"), lambda: letters.pop(at), lambda: letters.insert(at, "q")])()
    return "".join(letters)


def test_leaks_with_edits_and_clean_documents(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(18, 60))) for i in range(30)] + [(40, None), (41, ""), (42, "too short to say anything")]
    docs = []
    for i, (item, text) in enumerate(items[:30]):
        planted = edited(rng, text, int(0.07 * min(len(text), decontam.WINDOW)))
        docs.append((i, prose(rng, rng.randint(0, 200)) + " " + planted.upper().replace(" ", "\n") + " " + prose(rng, rng.randint(0, 200))))
    docs += [(100 + i, prose(rng, 300)) for i in range(30)] + [(200, None), (201, ""), (202, items[0][1][:30]), (203, prose(rng, 30_000) + items[1][1])]
    for blocks in (1_000_000, 1_000):
        found = decontam.find_leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string"), block_chars=blocks)
        caught = {(r.doc_id, leak.item) for r in found.collect() for leak in r.leaks}
        assert caught == {(i, i) for i in range(30)} | {(203, 1)}


def test_alignment_equals_a_full_table():
    rng = random.Random(2)
    for _ in range(150):
        window = "".join(rng.choice("abc") for _ in range(rng.randint(5, 25)))
        text = prose(rng, 3) + edited(rng, window, rng.randint(0, 4)) + prose(rng, 2)
        row = [0] * (len(text) + 1)
        for c in window:
            new = [row[0] + 1]
            for j, d in enumerate(text):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        met = decontam.align(decontam.codes_of(window), decontam.codes_of(text), 0, len(text), 6)
        assert (met is None) == (min(row) > 6)
        if met is not None:
            assert met[0] == min(row)


# --- personal data

def base_by_hand(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            n = int(c) * (1 + i % 2)
            total += n - 9 * (n > 9)
        return total % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{pii.BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


HARD = [
    "", None, "a@b.c_d@e.f g@h.i.j.k", "x" * 3000 + "@" + "y." * 3000 + "z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3", "9" * 4000,
    "4111 1111 1111 1111, 4111-1111-1111-1112, 5500000000000004", "+1 (509) 555-6973 +12 +1234567890123456 + 1", "é𝄞 mail é𝄞 q@r.st",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "a+b@c.d-e.f@g.h", "+49-30-1234567.", "0.0.0.0 255.255.255.255",
]


@given
def test_personal_data_base_spans(spark):
    docs = list(texts(spark).items()) + [(1000 + i, t) for i, t in enumerate(HARD)]
    found = pii.find_pii(spark.createDataFrame(docs, DOC), carry=("doc_id", "text"))
    for r in found.collect():
        base = sorted((s.start, pii.BASE.index(s.kind), s.end) for s in r.pii if s.kind in pii.BASE)
        assert ",".join(f"{pii.BASE[k]}:{a}:{b}" for a, k, b in base) == base_by_hand(r.text or "")


def test_personal_data_added_by_the_model(spark):
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    docs = [(i, f"call +1 ({digits(3)}) {digits(3)}-{digits(4)} please, order {digits(9)} of {digits(4)}") for i in range(600)]
    docs += [(1000, "call (509) 555-6973 please"), (1001, "order 123456789 of 2024"), (1002, "nothing here")]
    found = {r.doc_id: [(s.kind, r.text[s.start:s.end]) for s in r.pii] for r in pii.find_pii(spark.createDataFrame(docs, DOC), carry=("doc_id", "text")).collect()}
    assert found[1000] == [("local_phone", "(509) 555-6973")]
    assert found[1001] == [] and found[1002] == []
    redacted = {r.doc_id: r.text for r in pii.redact_pii(spark.createDataFrame(docs, DOC)).collect()}
    assert redacted[1000] == "call [private] please" and redacted[1002] == "nothing here"


# --- pages

@given
def test_main_text_of_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in QUERIES["op9_html_text"](spark, FOLDER).collect():
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1|footer|body|html)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


LONG = "This is the text that we want to keep, as it is long and has many of the words that are in a text of the kind that people write."


POLISH = "Wszystkie dzieci rodzą się wolne, lecz nie każde z nich może żyć w pokoju, dlatego trzeba chronić ich prawa oraz zapewnić im naukę przez wiele lat."
RUSSIAN = "Все люди рождаются свободными и равными в своём достоинстве и правах, они наделены разумом и совестью и должны поступать по совести."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("just words", ""), (f"<p>{LONG}", LONG), (f"<script>var a = '<p>{LONG}</p>'</script><p>{LONG}</p><p cla", LONG),
    (f"<nav><p>{LONG}</p></nav><main><p>{LONG}<p>Short.</main><footer>{LONG}</footer>", f"{LONG}\nShort."),
    (f"<article><p>{LONG}</p><div class='reader-comments'><p>{LONG}</p></div><form>{LONG}</form></article>", LONG),
    (f"<div id=cookieNotice>{LONG}</div><div><h1>Head</h1><p>{LONG} &amp; &lt;b&gt;</p><p>{LONG}</p></div>", f"Head\n{LONG} & <b>\n{LONG}"),
    (f"<article><p>{LONG}</p><p><a href=x>{LONG}</a></p><p>One<br>two<br><br>three &eacute;&nbsp;x</p></article>", f"{LONG}\n{LONG}\nOne two\nthree é x"),
    (f"<article><p>{LONG}</p><p>See <a href=x>this page about things</a></p><ul><li><a href=y>One item</a></li><li><a href=z>Two</a></li></ul></article>",
     f"{LONG}\nSee this page about things\nOne item\nTwo"),
    (f"<article><p>{LONG} E = <math><mi>m</mi><mi>c</mi></math> holds.</p></article>", f"{LONG} E = mc holds."),
    (f"<div>{POLISH}</div><div>{POLISH}</div><div><a href=x>{POLISH}</a></div><nav>{POLISH}</nav>", f"{POLISH}\n{POLISH}"),
    (f"<div>{RUSSIAN}</div><div>{RUSSIAN} <b>Ещё</b></div>", f"{RUSSIAN}\n{RUSSIAN} Ещё"),
    (f"<p><b>{LONG}<i>x</b></i></b></em></span> y</p><ul><li>{LONG}<li>{LONG}</ul>", f"{LONG}x y\n{LONG}\n{LONG}"),
])
def test_main_text_of_planted_pages(page, want):
    assert html_text.main_text(page) == want


def test_many_tags_that_match_nothing_take_no_more_than_linear_time():
    n = 100_000
    began = time.perf_counter()
    assert html_text.main_text("<b>" * n + "x</i>" * n) == "x" * n  # one long block in no language that is known
    assert html_text.main_text("<b>" * n + "<p></p>" * n + "</div>" * n) == ""
    assert html_text.main_text(f"<div>" * n + f"<p>{LONG}</span>" + "</b>" * n) == LONG
    assert time.perf_counter() - began < 30


# --- mixing

def test_flow_moves_overlapping_sources():
    # pattern {0,1} must serve source 1, as pattern {0} alone can fill source 0
    assert mixing.min_cost_flow([10, 10], [[0], [0, 1]], [10, 10], 2) == [10, 10]
    # the second repetition is used only where the first does not reach
    assert mixing.min_cost_flow([10, 10], [[0], [1]], [15, 5], 2) == [15, 5]
    assert mixing.min_cost_flow([10, 4, 6], [[0], [0, 1], [1]], [12, 10], 2) == [10, 4, 8] or sum(
        mixing.min_cost_flow([10, 4, 6], [[0], [0, 1], [1]], [12, 10], 2)) == 22
    assert mixing.min_cost_flow([], [], [], 2) == []


def test_capped_targets_share_the_excess():
    targets = mixing.capped_targets([100, 100, 100], [3, 1, 2], 450, 2)
    assert targets == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.capped_targets([0, 0], [3, 1], 0, 2) == [0, 0]


# --- pipeline

@given
def test_pipeline_by_hand(spark):
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    docs = texts(spark)
    quality = {r.doc_id for r in QUERIES["op1_quality_rules"](spark, FOLDER).collect() if r.kept}
    docs = {i: t for i, t in docs.items() if i in quality}
    docs = {i: docs[i] for i, (_, c) in joined_by_hand(docs).items() if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    index = decontam.WindowIndex.of(items)
    docs = {i: t for i, t in docs.items() if not decontam.leaks_of(t, index)}
    assert set(found) <= set(docs)
    sizes = Counter()
    for r in found.values():
        sizes[r.source] += r.taken
        assert r.taken in (r.size, 2 * r.size) and not re.search("[0-9a-f]{24}", r.text) and r.n_chars == len(r.text)
    targets = {r.source: r.target for r in found.values()}
    largest = max(len(WORD.findall(t)) for t in docs.values())
    assert all(abs(sizes[s] - t) <= largest for s, t in targets.items())


# --- whole kinds of personal data

def iban(country, body):
    number = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{country}{98 - number % 97:02d}{body}"


def test_personal_data_of_the_further_kinds_is_added(spark):
    rng = random.Random(11)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    docs = [(i, f"order {digits(9)} of {digits(4)}, no. {digits(7)}, call +1 ({digits(3)}) {digits(3)}-{digits(4)} please") for i in range(300)]
    good, bad = iban("DE", "370400440532013000"), iban("GB", "NWBK60161331926819")
    bad = bad[:2] + ("10" if bad[2:4] != "10" else "11") + bad[4:]
    rows = [(1000, f"pay to {good} today"), (1001, f"pay to {bad} today"), (1002, "write jane.doe (at) example (dot) com now"), (1003, "see [at] x.1 there")]
    for some in (rows, docs + rows):  # without a model, and as a share of candidates too small for a threshold
        frame = spark.createDataFrame(some, DOC)
        found = {r.doc_id: [(s.kind, r.text[s.start:s.end]) for s in r.pii] for r in pii.find_pii(frame, carry=("doc_id", "text")).collect()}
        assert found[1000] == [("account", good)] and found[1002] == [("email_words", "jane.doe (at) example (dot) com")]
        assert found[1001] == [] and found[1003] == []


def test_rare_kinds_get_a_threshold(spark):
    rng = random.Random(12)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    docs = [(i, " ".join(f"order {digits(9)}," for _ in range(200))) for i in range(300)]  # 60,000 plain runs
    docs += [(1000 + i, f"phone: ({digits(3)}) {digits(3)}-{digits(4)} or so") for i in range(120)]
    found = pii.find_pii(spark.createDataFrame(docs, DOC), carry=("doc_id", "text")).collect()
    assert all([s.kind for s in r.pii] == (["local_phone"] if r.doc_id >= 1000 else [s.kind for s in r.pii if s.kind in pii.BASE]) for r in found)


def test_the_model_learns_from_all_candidates(spark, monkeypatch):
    seen = []

    class Counted(pii.GBTClassifier):
        def fit(self, df):
            seen.append((df.count(), round(sum(r[0] for r in df.select("_weight").collect()), 6)))
            return super().fit(df)

    monkeypatch.setattr(pii, "GBTClassifier", Counted)
    candidates = spark.range(8000).selectExpr(
        "'digits' AS kind", "CAST(id % 2 AS double) AS label", "id DIV 2 AS _pick", *[f"CAST({'id % 2' if f == 'cue_phone' else 0} AS double) AS {f}" for f in pii.FEATURES])
    _, _, thresholds = pii.fit_model(candidates, 0.98, 5)
    assert seen == [(6000, 0.75 * 2 * pii.CELL)] and set(thresholds) == {"digits"}
