from __future__ import annotations

import numpy as np

from tarmac.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    result = queries.queries()["op6_quality"](spark, SF)
    assert result.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = result.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_flattened_trees_equal_a_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > 0)).astype(float)
    forest = quality.boost(x, y, rounds=30)

    def walk(row):
        total = forest.base
        for tree in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + (row[forest.feature[tree, node]] > forest.threshold[tree, node])
            total += forest.leaf[tree, node - forest.feature.shape[1]]
        return total

    assert np.allclose(forest.margins(x), [walk(r) for r in x])
    assert np.mean((forest.scores(x) >= 0.5) == y) > 0.95


def test_one_label_or_none_gives_a_constant():
    x = np.zeros((5, 3))
    assert quality.boost(x, np.ones(5)).scores(x).min() > 0.5
    assert quality.boost(np.zeros((0, 3)), np.zeros(0)).scores(x).tolist() == [0.5] * 5


def test_statistics_of_odd_texts():
    for text in (b"", b" \n\t ", b"a", "é日🙂".encode(), b"x " * 50_000, b"\n\n\n", b"| " * 9):
        values = quality.statistics(text)
        assert values.shape == (len(quality.NAMES),) and np.isfinite(values).all()
    assert not quality.statistics(b"").any()
    repeated = dict(zip(quality.NAMES, quality.statistics(b"so so so so"), strict=True))
    assert repeated["repeated_neighbours"] == 1 and repeated["distinct_words"] == 0.25


def test_nulls_conflicting_labels_and_clashing_columns(frame, spark):
    docs = frame(
        [(i, None if i % 7 == 0 else f"text {i} " * (i % 5), 0.1, 1) for i in range(60)] + [(None, "x", 0.2, 0)],
        "doc_id bigint, text string, score double, label int",
    )
    labels = frame(
        [(i, i % 2) for i in range(50)] + [(3, 0), (4, None), (None, 1), (5, 9)], "doc_id bigint, quality int"
    )
    forest = quality.train(docs, labels)
    rows = quality.score(docs, forest).collect()
    assert len(rows) == 61 and all(0 <= r["score"] <= 1 for r in rows)
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score(docs, quality.train(docs, empty)).collect()} == {0.5}
    assert quality.score(docs.limit(0), forest).collect() == []
