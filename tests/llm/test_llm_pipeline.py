from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
from test_llm_minhash import brute_force
from tokenizers import Tokenizer

from tarmac.llm import decontaminate

COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}


def test_stages_equal_a_brute_force_version(spark, frame):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]

    spoken = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    last = {}
    for i, t in spoken:
        last[t] = max(i, last.get(t, i))
    unique = [(i, t) for i, t in spoken if last[t] == i]
    roots = brute_force(unique, percent=corpus_pipeline.NEAR_PERCENT)
    apart = [(i, t) for i, t in unique if roots[i][1] == i]
    leaks = decontaminate.contaminated(
        frame(apart, "doc_id bigint, text string"), spark.read.parquet(f"{sf}/benchmark.parquet")
    )
    dirty = {r["doc_id"] for r in leaks.collect()}
    clean = [(i, t) for i, t in apart if i not in dirty]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for i, t in clean:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        expected[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())

    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == expected
    assert len(rows) > len(unique) > len(apart) > len(clean) > 0


def test_stages_keep_columns_and_take_odd_tables(spark, frame):
    sf = "/root/testdata/sf0.001"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, id int"
    odd = [
        (1, None, "en", "s", 0, "k", 1), (2, "", "en", "s", 0, "k", 1), (3, "12 34", None, "s", 0, "k", 1),
        (4, "hello there", "en", "s", 0, "k", 1), (5, "hello there", "en", "s", 0, "k", 1), (None, "bye now", "en", "s", 0, "k", 1),
    ]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), schema)
        left = sorted((r["doc_id"] or 0) for r in docs.collect())  # 1 to 3 have no letter
        assert left == ([0, 5] if rows else [])
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == len(left)


def test_near_duplicate_stage_links_from_080_on(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    roots = brute_force(rows, percent=80)
    assert roots != brute_force(rows, percent=85)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()}
    assert kept == {i for i, (_, root) in roots.items() if root == i}


def test_rows_are_dropped_by_their_text_and_repeated_rows_become_one(spark):
    sf = "/root/testdata/sf0.001"
    schema = "doc_id bigint, text string, lang string"
    long = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, "clean text", "en"), (1, "dup text", "en"), (5, "dup text", "en"),
        (7, "same row", "en"), (7, "same row", "en"), (7, "same row", "en"),
        (8, long, "en"), (9, "a text of nine", "en"), (9, "another text of nine", "en"), (10, long + " more", "en"),
    ]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), schema)
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == [
        (1, "clean text"), (5, "dup text"), (7, "same row"), (8, long), (9, "a text of nine"), (9, "another text of nine"),
    ]


def test_a_text_is_judged_alike_whatever_else_is_in_the_table(spark):
    sf, schema = "/root/testdata/sf0.001", "doc_id bigint, text string, lang string"
    odd = [(1, None, None), (2, "12 34", None), (3, "", None), (4, "a letter", None)]
    for others in ([], [(5, "some words of a language", "en")]):
        left = corpus_pipeline.language_id(spark, spark.createDataFrame(odd + others, schema), sf).collect()
        assert {r["doc_id"] for r in left if r["doc_id"] < 5} == {4}


def test_only_texts_like_no_language_are_rejected_by_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, "/root/testdata/sf0.01")
    assert kept.count() == docs.filter("text rlike '\\\\p{L}'").count()
