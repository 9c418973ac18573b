from __future__ import annotations

import numpy as np
import pytest

from tarmac.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    result = queries.queries()["op4_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = result.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    judged = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in judged]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("count", [2, 4, 6, 7, 40])
def test_codewords_part_all_languages(count):
    codes = language.codewords(count)
    distances = [(codes[i] != codes[j]).sum() for i in range(count) for j in range(i)]
    assert min(distances) >= (1 if count == 2 else 2 if count == 3 else codes.shape[1] // 4)
    assert np.all(np.abs(codes.sum(axis=0)) < count)


def test_long_texts_are_counted_whole():
    text = "abc déf " * 60_000
    counts = language.ngram_counts(text)
    assert counts.sum() == 2 * (len(text) + 2) - 3
    short = language.ngram_counts("abc déf ")
    assert set(np.flatnonzero(short)) <= set(np.flatnonzero(counts))


def test_nulls_letterless_texts_and_clashing_columns(frame):
    rows = [(1, "hello there good people", "en", 0.0), (2, "bonjour à tous mes amis", "fr", 0.0)] * 6
    rows = [(i, *row[1:]) for i, row in enumerate(rows)]
    docs = frame(rows, "doc_id bigint, text string, lang string, score double")
    model = language.train(docs.select("doc_id", "text", "lang"))
    asked = [(1, None, "a"), (2, "", "b"), (3, "12 ?! \n", "c"), (4, "ok good", "d"), (None, "à mes amis", "e"), (4, "ok good", "d")]
    got = language.identify(frame(asked, "doc_id bigint, text string, lang_pred string"), model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [
        (0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"),
    ]
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_nothing_to_learn_and_one_language(frame, spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = language.train(empty)
    docs = frame([(1, "hello")], "doc_id bigint, text string")
    assert [tuple(r)[1:3] for r in language.identify(docs, model).collect()] == [("und", 0.0)]
    assert language.identify(empty, model).collect() == []
    one = language.train(frame([(i, "only this", "xx") for i in range(9)], "doc_id bigint, text string, lang string"))
    assert [r["lang_pred"] for r in language.identify(docs, one).collect()] == ["xx"]


def test_ambiguity_is_flagged():
    model = language.LanguageModel(["a", "b"], np.array([[1.0], [-1.0]]), np.zeros((1, 1)), np.ones(1))
    best, score, lead = language.decode(model, np.array([[0.001], [1.0], [0.0]]))
    assert best.tolist() == [0, 0, 0] and lead[0] < language.AMBIGUOUS_MARGIN < lead[1] and score[2] == 0.5
