"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelweave.llm import chat, decontam, graph, html_text, mixing, ngram_join, pii, quality, secret_scan, suffix_dedup, urls
from panelweave.llm import spans as S

WORDS = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
ROWS = [
    (1, WORDS, None, "a"), (1, WORDS, None, "a"), (2, None, "en", None), (3, "", "en", "a"), (None, WORDS + " more", "en", "b"), (4, "x" * 200_000, "en", "b"),
    (5, "é " * 30_000, "en", "b"), (6, "mail a@b.cd token = abcdef123456 1.2.3.4", "en", "b"), (7, WORDS, None, "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHES = ("kept", "size", "taken", "target", "secrets", "leaks", "n_bytes", "n_words", "Pii", "n_spans")


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return frame.withColumns({c: F.lit("own") for c in CLASHES})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, WORDS[:300]), (3, "")], "item_id long, text string")


def outputs(docs, benchmark):
    return {
        "quality": quality.apply_rules(docs, measures=("n_words",)),
        "join": ngram_join.similarity_classes(docs),
        "near": ngram_join.drop_near_copies(docs),
        "repeats": suffix_dedup.remove_repeats(docs),
        "leaks": decontam.find_leaks(docs, benchmark),
        "secrets": secret_scan.scan_secrets(docs),
        "redacted": secret_scan.redact_secrets(docs),
        "pii": pii.find_pii(docs, carry=docs.columns),
        "mix": mixing.mix_by_source(docs.drop("size").withColumn("size", F.size(F.split(F.coalesce("text", F.lit("")), " ")))),
    }


def test_every_operator_on_hard_rows(docs, benchmark):
    out = {k: v.collect() for k, v in outputs(docs, benchmark).items()}
    assert all(len(v) == len(ROWS) for k, v in out.items() if k != "near")
    assert sorted(r.doc_id or -1 for r in out["near"]) == [1, 2, 3, 4, 5, 6]  # 1 once, 7 and the null key are its near copies
    assert {r.doc_id: r.component_id for r in out["join"]} == {1: 1, 2: 2, 3: 3, None: 1, 4: 4, 5: 5, 6: 6, 7: 1}
    assert [r.kept for r in out["quality"] if r.doc_id in (1, 2, 3)] == [True, True, False, False]
    assert {r.doc_id for r in out["leaks"] if r.leaks} == {1, 7, None}
    removed = {r.doc_id: r.n_removed for r in out["repeats"]}
    assert removed[1] == 0 and removed[7] == len(WORDS) == removed[None] and removed[2] == 0
    assert {r.doc_id: r.text for r in out["redacted"]}[6].startswith("mail a@b.cd [secret] 1.2") and {r.doc_id: r.text for r in out["redacted"]}[2] is None
    assert [[s.kind for s in r.pii] for r in out["pii"] if r.doc_id == 6] == [["email", "ip"]]
    assert all(set(CLASHES) - {c for c in r.asDict()} <= {"n_bytes", "kept", "n_spans"} for r in out["repeats"])
    assert out["secrets"][0]["size"] == "own" and out["mix"][0]["secrets"] == "own"


def test_every_operator_on_an_empty_table(none, benchmark):
    assert all(v.count() == 0 for v in outputs(none, benchmark).values())


def test_an_empty_benchmark_finds_nothing(docs, benchmark):
    assert decontam.find_leaks(docs, benchmark.limit(0)).filter(F.size("leaks") > 0).count() == 0


def test_stages_on_hard_rows_and_on_none(spark, docs, none, tmp_path):
    spark.createDataFrame([(2, "nothing of interest")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    plain = docs.drop(*CLASHES)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, plain.limit(0), str(tmp_path)).count() == 0
        done = stage(spark, plain, str(tmp_path))
        assert done.count() > 0 and done.columns[:5] == plain.columns


def test_urls(spark):
    pages = [
        (1, None), (2, ""), (3, "no scheme/at/all"), (4, "http://A.Example.ORG/es/x?y"), (4, "http://A.Example.ORG/es/x?y"), (5, "http://example.org"), (6, "x://org/"),
        (7, "http://www.a.com/fr/../de/"), (8, "http://com/de/"), (9, "http://xcom/de/"), (10, "http://a.com?/de/"), (11, "a\nb://q.com/de/#f"), (12, "http://a..com/fr/"),
        (13, "http://" + "a." * 60 + "example.org/en/1" + "0" * 50_000),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("rule", F.lit("own")).withColumn("Host", F.lit("own"))
    got = {r.page_id: (r.rule, r.verdict) for r in urls.filter_urls(frame).collect()}
    assert urls.filter_urls(frame).count() == len(pages)
    assert got == {1: (None, "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: ("example.org/es/", "block"), 5: (None, "allow"), 6: ("org/", "allow"),
                   7: ("com/fr/", "allow"), 8: ("com/de/", "block"), 9: (None, "allow"), 10: (None, "allow"), 11: ("com/de/", "block"), 12: ("com/fr/", "allow"),
                   13: ("example.org/en/1", "block")}
    assert urls.filter_urls(frame.limit(0)).count() == 0 and urls.filter_urls(frame, rules=()).filter("rule IS NOT NULL").count() == 0
    nested = [urls.UrlRule("org", p, v) for p, v in (("", "a"), ("/x", "b"), ("/x/y", "c"), ("/x/y/z", "d"), ("/xa", "e"))]
    paths = spark.createDataFrame([(i, "s://k.org" + p) for i, p in enumerate(["", "/", "/x", "/x/y!", "/x/y/z/z", "/x/z", "/xab", "/y"])], "page_id long, url string")
    assert [r.verdict for r in urls.filter_urls(paths, nested).orderBy("page_id").collect()] == list("aabcdbea")


def test_chat_round_trip_and_turn_order(spark):
    hard = ["", None, "\\", "\\\\b\\t", "### ### x", "</turn>\n### user:\n", "###", "</turn", "a\\h## b", "é𝄞" * 50_000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hard)]
    rows += [(2, 0, "assistant", "first"), (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "a"), (4, 0, "odd:\nrole### ", "t"), (4, None, None, "null turn")]
    rows += [(5, 0, "user", "b"), (5, 0, "user", "a"), (5, 0, "user", "a"), (None, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit("own"))
    done = chat.format_conversations(frame)
    back = {r.conv_id: r for r in done.select("conv_id", "well_formed", "final_state", "first_bad_turn", "segments", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r, t or "") for _, _, r, t in rows[:len(hard)]]
    assert {k: (r.final_state, r.first_bad_turn) for k, r in back.items()} == {
        1: ("assistant", None), 2: ("reject", 0), 3: ("assistant", None), 4: ("reject", 0), 5: ("reject", 1), None: ("user", None)}
    assert {k: r.well_formed for k, r in back.items()} == {1: True, 2: False, 3: True, 4: False, 5: False, None: False}
    assert [(t.role, t.text) for t in back[4].turns] == [("", "null turn"), ("odd:\nrole### ", "t")]
    assert [t.text for t in back[5].turns] == ["a", "a", "b"]
    assert [s.role for s in back[3].segments if s.loss] == ["assistant"]
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_pages(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, "<p>" * 20_000), (4, "<div class='a" + "x" * 50_000), (5, "<script>" * 1000)]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("Text", F.lit("own"))
    assert [r.text for r in html_text.extract_main_text(frame).orderBy("page_id").collect()] == [""] * 6
    assert html_text.extract_main_text(frame.limit(0)).count() == 0


def test_secrets_are_linked_across_parts(spark):
    key, blob = "AKIA" + "ABCD1234" * 2, "aB3/" * 10
    far = " and so on" * 60
    rows = [
        (1, f"id {key} secret part {blob} at https://s3.example.com/x"), (2, f"only {blob} at https://s3.example.com/x"), (3, f"user: joe {far} token = abcdef99"),
        (4, "user: joe token = abcdef99"), (5, f"{blob} {far} {key}"), (6, f"{key} {key} {blob}{blob}"),
    ]
    got = {r.doc_id: [s.kind for s in r.secrets] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {
        1: ["access", "blob", "endpoint"], 2: [], 3: ["assign"], 4: ["assign", "ident"], 5: ["access"], 6: ["access", "access", "blob"]}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    roots = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200, 202: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_very_many_matches(spark):
    n = 100_000
    numbers, mails, keys = "12 " * n, "a@b.cd " * n, "token=abcdef1 " * n
    frame = spark.createDataFrame([(1, numbers), (2, mails), (3, keys)], "doc_id long, text string")
    began = time.perf_counter()
    spans = frame.select("doc_id", F.size(S.match_spans(F.col("text"), "[0-9]+", "n")).alias("n"), F.get(S.match_spans(F.col("text"), "[0-9]+", "n"), F.lit(n - 1))["start"].alias("last"))
    assert {r.doc_id: (r.n, r["last"]) for r in spans.collect()} == {1: (n, 3 * (n - 1)), 2: (0, None), 3: (n, 14 * (n - 1) + 12)}
    found = {r.doc_id: len(r.secrets) for r in secret_scan.scan_secrets(frame).collect()}
    assert found == {1: 0, 2: 0, 3: n}
    redacted = {r.doc_id: r.text for r in secret_scan.redact_secrets(frame.filter("doc_id = 3")).collect()}
    assert redacted[3] == f"{secret_scan.MARK} " * n
    assert time.perf_counter() - began < 120


def test_keys_of_all_lengths_and_sql_agree(spark):
    import duckdb

    token = lambda n: ("aB3+" * 40)[:n]
    key = "AKIA" + "ABCD1234" * 2
    texts = [f"aws_access_key_id={key}\naws_secret_access_key={token(40)}\n", f"{key} {token(64)}", f"{key} {token(86)}==", f"{key} {token(31)}", f"{key} {token(128)}", f"{key} {token(129)}",
             f"{key} {token(40)}===", f"{key} {token(40)}=x", f"{key} {token(40)}=", f"only {token(64)}", f"user=joe {token(50)}/ https://a.b/c {'f' * 30}", f"{key} {'a' * 40} {'A1' * 20}", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.scan_secrets(frame)
    got = {r.doc_id: r.spans for r in found.select("doc_id", S.joined(F.col("secrets"), secret_scan.KINDS).alias("spans")).collect()}
    documents = frame.toPandas()  # noqa: F841
    want = dict(duckdb.sql(secret_scan.OP6_SQL).df()[["doc_id", "spans"]].itertuples(index=False))
    assert got == want
    assert "blob" in got[0] and "blob" in got[1] and "blob" in got[2] and "blob" not in got[3] and "blob" in got[4] and "blob" not in got[5]
    assert "blob" not in got[6] and "blob" not in got[7] and "blob" in got[8] and got[9] == ""
