"""Cases that the operators once left out."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from panelweave.llm import decontam, html_text, ngram_join, secret_scan, suffix_dedup
from panelweave.llm.shingles import _BYTE, _INVERSE, _STEP, mix, powers


# --- decontamination

def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_passages_between_windows_and_short_items():
    rng = random.Random(21)
    item, short, tiny = words(rng, 90)[:394], "What is the capital of France?", "Foo 12"
    index = decontam.WindowIndex.of([(1, item), (2, short), (3, tiny)])
    found = lambda text: {(leak[0], leak[3]) for leak in decontam.leaks_of(text, index)}
    for a, b in ((20, 270), (110, 310), (7, 126), (394 - 125, 390)):
        assert found(f"{words(rng, 50)} {item[a:b]} {words(rng, 50)}") == {(1, 0)}
    text = f"{words(rng, 10)} {short.upper()} {words(rng, 10)}"
    assert found(text) == {(2, 0)} and found(text.replace("CAPITAL", "CAPITOL")) == set()
    assert found("a foo 12") == {(3, 0)} and found("a foo 123") == set() == found("afoo 12") and found("foo 12" + " x" * 40_000) == {(3, 0)}
    assert found("y" * 40_000 + " " + short) == {(2, 0)} and found(words(rng, 300)) == set()


# --- suffix dedup

def piece_hashes(data):
    data = np.frombuffer(data, dtype=np.uint8)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_STEP, len(data))[:len(data)], out=sums[1:])
    return mix((sums[16:] - sums[:-16]) * powers(_INVERSE, len(data) + 1)[:len(data) - 15])


def test_a_naming_piece_that_comes_again_at_the_width():
    rng = random.Random(23)
    letters = lambda n: bytes(rng.choice(b"abcdefghijklmnop") for _ in range(n))
    pool = letters(100_000)
    low = np.argsort(piece_hashes(pool), kind="stable")[:40]
    pieces = [pool[i:i + 16] for i in low]  # 0 and 1 are the least, the rest name what is between them
    filler = letters(19)
    one = letters(60) + pieces[0] + pieces[39] + filler + pieces[39] + pieces[1] + letters(60)
    at = 60 + 16  # first copy of the piece; strings at + 1 .. at + 16 hold the second one only
    other = b"#" * 30 + one[at + 1:at + 66] + b"#" * 30
    own = suffix_dedup.contexts([one, other])
    name = piece_hashes(pieces[39])[0]
    marks = [own.marks[(own.owner == i) & (own.name == name)] for i in (0, 1)]
    assert len(marks[0]) == 1 and len(marks[1]) == 1
    agree = lambda bit, shift: (marks[0] >> bit & 1) & (marks[1] >> bit & 1) & ((marks[0] ^ marks[1]) >> shift & 255 == 0)
    assert (marks[0] | marks[1]) >> suffix_dedup.UNKNOWN & 1 or agree(suffix_dedup.LEFT, 8) or agree(suffix_dedup.RIGHT, 0)


def test_repeats_of_records_at_the_width(spark):
    rng = random.Random(24)
    letters = lambda n: bytes(rng.choice(b"abcdefghijklmnop") for _ in range(n))
    pool = letters(100_000)
    pieces = [pool[i:i + 16] for i in np.argsort(piece_hashes(pool), kind="stable")[:40]]
    docs = []
    for i in range(20):
        one = letters(60) + pieces[0] + pieces[39] + letters(19) + pieces[39] + pieces[1] + letters(60)
        docs += [(2 * i, one.decode()), (2 * i + 1, "#" * 30 + one[77:142].decode() + "#" * 30)]
    found = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    seen = set()
    for key, text in docs:
        data, cut = text.encode(), set()
        for i in range(len(data) - 49):
            if data[i:i + 50] in seen:
                cut |= set(range(i, i + 50))
        seen |= {data[i:i + 50] for i in range(len(data) - 49)}
        assert found[key] == bytes(c for i, c in enumerate(data) if i not in cut)


# --- pages

LONG = "This is the text that we want to keep, as it is long and has many of the words that are in a text of the kind that people write."


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "page-with-comments", "ad-free", "share-price"])
def test_names_that_only_mention_what_is_left_out(name):
    assert html_text.main_text(f"<div class='{name}'><article><p>{LONG}</p></article></div>") == LONG
    assert html_text.main_text(f"<div class='{name}'><p>{LONG}</p></div>") == LONG


@pytest.mark.parametrize("name", ["ad", "ad-slot", "sidebar-left", "reader-comments", "comment-list", "social-links", "cookieNotice"])
def test_names_of_what_is_left_out(name):
    assert html_text.main_text(f"<div class='{name}'><p>{LONG}</p></div><p>{LONG} End.</p>") == f"{LONG} End."


@pytest.mark.parametrize("page, want", [
    (f"<div class=widget><p>{LONG} 1</p><main><p>{LONG} 2</p></main></div>", f"{LONG} 1\n{LONG} 2"),
    (f"<form id=page><main><p>{LONG}</p></main></form>", LONG),
    (f"<aside><article><p>{LONG} 1</p></article></aside><p>{LONG}</p>", LONG),
    (f"<div class=comments><article class=comment><p>{LONG} 1</p></article></div><p>{LONG}</p>", LONG),
    (f"<article><h2 class='section-header'>Heading</h2><p>{LONG}</p><figure><figcaption>{LONG} 3</figcaption></figure></article>", f"Heading\n{LONG}\n{LONG} 3"),
])
def test_wrappers_headings_and_captions(page, want):
    assert html_text.main_text(page) == want


# --- secrets

def test_keys_behind_an_equals_sign_and_of_other_lengths_are_redacted(spark):
    rng = random.Random(22)
    token = lambda n: "aB3" + "".join(rng.choice("abcdefXYZ0189+/") for _ in range(n - 3))
    key, forty, long, padded = "AKIA" + "ABCD1234" * 2, token(40), token(64), token(86) + "=="
    rows = [(1, f"aws_access_key_id={key}\naws_secret_access_key={forty}\n"), (2, f"user: joe key {long} end"), (3, f"client_id=abc key='{padded}'"), (4, f"only {long}")]
    out = {r.doc_id: r.text for r in secret_scan.redact_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == "aws_access_key_id=[secret]\naws_secret_access_key=[secret]\n"
    assert out[2] == "[secret] key [secret] end" and out[3] == "[secret] key='[secret]'" and out[4] == f"only {long}"


# --- near copies

def test_different_texts_without_an_id_or_with_a_shared_one(spark):
    rng = random.Random(25)
    prose = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    base = [prose() for _ in range(8)]
    near = base[0] + " more"
    docs = [(1, base[0]), (None, near), *[(None, t) for t in base[1:5]], (None, base[1] + " more"), (7, base[5]), (7, base[6]), (7, base[6]), (8, base[7]), (9, base[7]), (9, "")]
    kept = ngram_join.drop_near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    kept = sorted((r.doc_id or 0, r.text) for r in kept)
    assert len(kept) == 9 and kept.count((7, base[6])) == 1
    assert {(1, base[0]), (0, base[2]), (0, base[3]), (0, base[4]), (7, base[5]), (7, base[6]), (8, base[7]), (9, "")} <= set(kept)
    assert sum(t in (base[1], base[1] + " more") for _, t in kept) == 1


def test_prefixes_travel_by_class_and_slice_and_a_small_cluster_is_shipped_once(spark, monkeypatch):
    rng = random.Random(41)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    base = prose(60)
    near = [f"{base} {prose(2)}" for _ in range(150)]
    docs = [*near, *near[:40], *[prose(40) for _ in range(30)]]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    kept, shipped, tokens, verify, prefix_tokens = [], [], [], ngram_join.verify, ngram_join.prefix_tokens

    def counted(units, order, percent):
        shipped.append(units.count())
        return verify(units, order, percent)

    def seen(rows, classes, percent):
        found = prefix_tokens(rows, classes, percent)
        tokens.append((found.count(), rows.join(classes.selectExpr("node AS row"), "row", "left_semi").selectExpr("sum(size(prefix))").first()[0]))
        return found

    monkeypatch.setattr(ngram_join, "verify", counted)
    monkeypatch.setattr(ngram_join, "prefix_tokens", seen)
    for size, limit in ((ngram_join.SLICE, None), (20, None), (20, "1")):
        monkeypatch.setattr(ngram_join, "SLICE", size)
        if limit:
            spark.conf.set("spark.panelweave.maxBroadcastBytes", limit)
        try:
            kept.append(sorted(map(tuple, ngram_join.similarity_classes(frame).collect())))
        finally:
            spark.conf.unset("spark.panelweave.maxBroadcastBytes")
    assert kept[0] == kept[1] == kept[2] and [r[2] for r in kept[0][:190]] == [0] * 190 and kept[0][0][3] == 149
    assert shipped == [150] * 3  # 150 short texts are one block
    assert all(a == b for a, b in tokens)


def test_copies_of_a_context_are_cut_in_their_batch_and_travel_once():
    rng = random.Random(31)
    common = "".join(rng.choice("abcdefghijklmnop ") for _ in range(400))
    texts = [f"{i:05d} " * 12 + common for i in range(300)]
    own = suffix_dedup.contexts([t.encode() for t in texts], marked=False)
    names = [suffix_dedup.short_names(own.name[own.owner == i], 8).tolist() for i in range(300)]
    docs = pd.DataFrame({"key": range(300), "print": range(300), "text": texts, "names": names, "hot": names})
    packed = suffix_dedup.packed_contexts(docs, 8)
    sent = Counter()
    for row in packed[packed["kind"] != suffix_dedup.CUT].itertuples():
        ends = np.cumsum(row.sizes)
        sent.update(row.data[b - n:b] for b, n in zip(ends.tolist(), row.sizes.tolist()))
    inner = [c for c in sent if c in common.encode()]
    assert inner and all(sent[c] == 1 for c in inner)
    cut = [k for row in packed[packed["kind"] == suffix_dedup.CUT].itertuples() for k in row.keys]
    assert sorted(set(cut)) == list(range(1, 300))  # all but the smallest key lose the passage
    assert len(suffix_dedup.solve_shard(packed, 8).dropna(subset=["key"])) == 299


def test_strings_of_frequent_names_are_compared_without_a_join(spark):
    rows = [(0, [1, 2, 1], [5, 5, 5], [7, 7, 9], [70, 70, 90], [0, 1, 4]), (0, [1], [5], [8], [80], [30]), (1, [3], [5], [8], [80], [31])]
    done = suffix_dedup.frequent_cuts(spark.createDataFrame(rows, suffix_dedup.STRINGS))
    assert "Join" not in done._jdf.queryExecution().toString()
    assert sorted(map(tuple, done.collect())) == [(8, 80, [30], [80]), (9, 90, [4], [54])]
