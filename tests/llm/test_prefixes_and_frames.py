"""Prefix trie, token counts at prefixes and fill-in-middle frames: brute force, the tokenizer's library, exact round trips."""

import hashlib
import os
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelweave.llm import conv_trie, fill_middle, token_prefixes
from panelweave.llm.fill_middle import Frames
from panelweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
TURNS = "conv_id long, turn long, role string, text string"


# --- prefix trie

def trie_by_hand(sequences):
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, convs in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1].encode()) if path else 0)
            leaves[path[:d]] += not kids[path]
    digest = lambda path: hashlib.sha256(",".join(str(c) for c in sorted(members[path]) if len(sequences[c]) == len(path)).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], digest(p)) for p, m in members.items())


def trie_of(spark, sequences, units):
    rows = [(c, i, role, text) for c, turns in sequences.items() for i, (role, text) in enumerate(turns)]
    nodes = conv_trie.prefix_trie(conv_trie.turn_sequences(spark.createDataFrame(rows, TURNS)), units)
    return sorted((tuple(r) for r in nodes.collect()), key=lambda r: r[:2] + r[3:])


@pytest.mark.parametrize("n, texts, units", [(400, 3, 30), (2000, 2, 100), (200, 40, 1 << 18)])
def test_trie_over_blocks_and_levels(spark, monkeypatch, n, texts, units):
    monkeypatch.setattr(conv_trie, "LEAST_ROWS", 4)
    rng = random.Random(n)
    sequences = {c: [(rng.choice(["user", "assistant"]), f"t{rng.randrange(texts)}é") for _ in range(rng.randint(1, 6))] for c in rng.sample(range(-10, 10 * n), n)}
    for c in list(sequences)[:n // 3]:
        sequences[c] = [("user", "same"), ("a", "b")]
    assert trie_of(spark, sequences, units) == sorted(trie_by_hand(sequences), key=lambda r: r[:2] + r[3:])


def test_ends_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(conv_trie, "LEAST_ROWS", 2)
    monkeypatch.setattr(conv_trie, "PIECE", 3)
    sequences = {c: [("u", "x")] for c in range(95, 195)} | {7: [("u", "x"), ("v", "y")], 1000: [("u", "w")]}
    assert trie_of(spark, sequences, 16) == sorted(trie_by_hand(sequences), key=lambda r: r[:2] + r[3:])


def test_trie_of_hard_rows(spark):
    rows = [(1, None, None, "b"), (1, 0, "user", None), (2, 0, "u", "x"), (2, 0, "u", "x"), (3, 0, "u", "x"), (None, 0, "u", "x"), (4, 0, "u" * 50_000, "é" * 100_000), (5, 1, "", "u1:x")]
    frame = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("own")).withColumn("path", F.lit("own"))
    nodes = {(r.conv_id, r.depth): r for r in conv_trie.prefix_trie(conv_trie.turn_sequences(frame)).collect()}
    assert set(nodes) == {(1, 0), (1, 1), (1, 2), (2, 1), (2, 2), (4, 1), (5, 1)}
    assert nodes[1, 0].n_convs == 5 and nodes[1, 0].n_leaves == 4 and nodes[2, 1].n_convs == 2 and nodes[2, 1].saved_tokens == 1
    assert nodes[2, 1].ends_sha256 == hashlib.sha256(b"3").hexdigest() and nodes[1, 0].ends_sha256 == hashlib.sha256(b"").hexdigest()
    assert conv_trie.prefix_trie(conv_trie.turn_sequences(frame.limit(0))).count() == 0


def test_heads_of_an_absent_and_a_short_first_conversation(spark):
    rows = [(5, i, "u", f"five {i}") for i in range(2)] + [(6, i, "u", f"six {i}") for i in range(4)] + [(11, i, "u", f"eleven {i}") for i in range(3)]
    sequences = conv_trie.turn_sequences(spark.createDataFrame(rows, TURNS), "conv_id - conv_id % 5")
    grafted = {r.conv_id: r for r in conv_trie.graft_heads(sequences, "3").collect()}
    plain = {r.conv_id: bytes(r.path) for r in sequences.collect()}
    assert bytes(grafted[6].path) == plain[5] + plain[6][48:] and grafted[6].sizes == [6, 6, 5]
    assert bytes(grafted[11].path) == b"" and grafted[11].sizes == [] and bytes(grafted[5].path) == plain[5]


# --- token counts

@pytest.fixture(scope="module")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def library_count(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


HARD = ["abcdefghijklmnopqrstuvwxyz", "ABCxyz'srelvd!?.,-<|>  0123456789", "éüßÇñœİΣςǅªºŸſ", "日本語ภาษาไทยहिन्दी한국어각", "éä̸한", "  \x1c\x1d\x85​😀👍🏽٠Ⅰ½"]


def test_every_prefix_counts_as_the_library_does(vocabulary):
    counter, count, rng = token_prefixes.PrefixCounter(vocabulary), library_count(vocabulary), random.Random(31)
    stems = [t for t in sorted(counter.tokens) if t.isascii() and t.isalpha()]
    for k in range(1500):
        if k % 4 == 0:
            text = "".join(rng.choice(stems) for _ in range(rng.randint(1, 5)))
        elif k % 4 == 1:
            text = "".join(rng.choice(["<|endoftext|>", "<|startoftext|>", "<|", "ab", "'re", "!!", "'ll", " ", "É", "́"]) for _ in range(rng.randint(1, 8)))
        else:
            text = "".join(rng.choice(rng.choice(HARD)) for _ in range(rng.randint(1, 25)))
        changes, now, at = next(counter.prefix_changes([text.encode()])), 0, 0
        assert len(changes) == len(text.encode())
        for i, c in enumerate(text):
            at += len(c.encode())
            if changes[at - 1] != token_prefixes.INSIDE:
                now += int(changes[at - 1])
                assert now == count(text[:i + 1]), (text, i)
        assert now == count(text), text


def test_borders_hold_as_merging_says(vocabulary):
    counter, rng = token_prefixes.PrefixCounter(vocabulary), random.Random(32)
    tokens = rng.sample(sorted(t for t in counter.tokens if counter.tree(t)), 600)
    for left, right in zip([t for t in tokens if not t.endswith(token_prefixes.END)] * 3, tokens * 3):
        plain = [t[0] for t in counter.merged(token_prefixes._units(left) + token_prefixes._units(right))] == [left, right]
        assert counter.may_follow(left, right) == plain


def test_budget_questions_without_the_tokenizer(spark, vocabulary):
    count = library_count(vocabulary)
    rows = [(1, "The quick brown fox's 3 foxes aren't here — naïve <|endoftext|> été!"), (2, ""), (3, None), (4, "x" * 100_000), (5, "日本語" * 200), (None, " \n"), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("own")).withColumn("N_Bytes", F.lit("own"))
    index = token_prefixes.prefix_index(docs, vocabulary)
    limits = (0, 1, 5, 12, 10_000)
    asked = index.select("doc_id", "text", "n_bytes", "n_tokens", *[token_prefixes.fitting_bytes(F.col("prefix_tokens"), k).alias(f"fit{k}") for k in limits],
                         token_prefixes.tokens_in(F.col("prefix_tokens"), F.lit(9).cast("long")).alias("in9"))
    got = asked.collect()
    assert len(got) == len(rows)
    for r in got:
        data = (r.text or "").encode()
        assert (r.n_bytes, r.n_tokens) == (len(data), count(r.text or ""))
        assert r.in9 == count(data[:9].decode(errors="ignore"))
        for k in limits:
            if len(data) < 5000:
                best = max(n for n in range(len(data) + 1) if not (n < len(data) and data[n] & 0xC0 == 0x80) and count(data[:n].decode()) <= k)
                assert r[f"fit{k}"] == best
    limited = token_prefixes.prefix_index(docs.drop("n_tokens"), vocabulary, limit=5).select("doc_id", "fitting_bytes").collect()
    assert sorted((r.doc_id or 0, r.fitting_bytes) for r in limited) == sorted((r.doc_id or 0, r.fit5) for r in got)
    cut = {r.doc_id: r.text for r in token_prefixes.truncate(index.filter("doc_id IN (4, 5)"), 12).collect()}
    assert count(cut[4]) == count(cut[5]) == 12
    assert token_prefixes.prefix_index(docs.limit(0), vocabulary).count() == 0


@given
def test_counts_of_given_documents(spark, vocabulary):
    count = library_count(vocabulary)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op12_token_counts"](spark, FOLDER).collect()}
    assert got == {i: (len(t.encode()), count(t), count(t) > 2048) for i, t in texts.items()}


# --- fill in middle

def test_frames_and_round_trips():
    rng = random.Random(33)
    for _ in range(300):
        text = "".join(rng.choice("abAB <>PSMé日1\n") for _ in range(rng.randint(0, 60)))
        units, stored = re.findall("[A-Za-z]+|[^A-Za-z]", text), Frames.of([text.encode()] if text else [], rng.choice([4, 7, 16]))
        assert stored.units[-1] == len(units) and stored.chars[-1] == len(text) and b"".join(stored.stream()) == text.encode()
        assert [m for m, _ in stored.marks()] == re.findall("<[PSM]>", text)
        for i in range(len(units) + 1):
            assert stored.place(i) == (len("".join(units[:i])), len("".join(units[:i]).encode()))
        if re.search("<[PSM]>", text):
            continue
        a, b = sorted(rng.randint(0, len(units)) for _ in "ab")
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        for form, want in (("psm", f"<P>{prefix}<S>{suffix}<M>{middle}"), ("spm", f"<S>{suffix}<P>{prefix}<M>{middle}")):
            out = Frames.of(fill_middle._written(form, stored, stored.place(a)[1], stored.place(b)[1]), rng.choice([4, 5, 9]))
            assert b"".join(out.stream()).decode() == want and b"".join(fill_middle.restored(form, out)).decode() == text


def test_a_cut_touches_its_own_frame_only(monkeypatch):
    stored, touched = Frames.of([b"ab 1" * 10_000], 1000), []
    monkeypatch.setattr(Frames, "frame", lambda self, i, plain=Frames.frame: touched.append(i) or plain(self, i))
    stored.place(15_000)
    list(stored.stream(20_500, 21_500))
    assert len(touched) == 3


def test_fill_in_middle_on_hard_rows(spark):
    rows = [(i, f"word {i} é日 some more words here, {i * i}") for i in range(200)] + [(None, "no id"), (201, None), (202, ""), (203, "has <M> inside"), (204, "x" * 200_000), (205, "é " * 100_000), (0, "word 0 é日 some more words here, 0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Form", F.lit("own")).withColumn("frames", F.lit("own"))
    made = fill_middle.fill_in_middle(fill_middle.store_frames(docs, size=1 << 10)).collect()
    assert len(made) == len(rows)
    texts = dict(rows)
    for r in made:
        text = texts[r.doc_id] or ""
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.form == "plain") == (r.prefix_chars is None) == (r.output_sha256 == r.restored_sha256)
    assert {r.form for r in made} == {"plain", "psm", "spm"} and {r.form for r in made if r.doc_id in (201, 202, 203)} == {"plain"}
    assert len({(r.form, r.output_sha256) for r in made if r.doc_id == 0}) == 1
    assert fill_middle.fill_in_middle(fill_middle.store_frames(docs.limit(0))).count() == 0
