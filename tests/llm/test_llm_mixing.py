from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import mixing, queries

SCHEMA = "doc_id bigint, text string"
SF = "/root/testdata/sf0.01"


def lowered(text):
    return (text or "").encode().lower()


def base_scores(rows, learns):
    """(n_tokens, n_known, train_tokens, base score) per id, by the definition."""
    counts = Counter()
    for i, text in rows:
        if learns(i):
            counts.update(lowered(text).split())
            counts[None] += 1  # the end
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        tokens = [*lowered(text).split(), None]
        logs = (math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        out[i] = (len(tokens), sum(counts[t] > 0 for t in tokens), total, math.fsum(logs))
    return out


def plain_cost(text, model):
    """The cost of a text decision by decision, with integers and rules of its own."""
    data = text.lower() + b"\xff"
    mask = (1 << 64) - 1
    weights = model.weights.astype(np.float64)
    cost, done = 0.0, 0

    def learned(teach, size):
        return weights + min(mixing.MOST_STEP, mixing.RATE * size) / size * teach

    for part in (data[at : at + mixing.SEGMENT] for at in range(0, len(data), mixing.SEGMENT)):
        begun, size, teach = 0, 0, np.zeros(6)
        left = min(mixing.BLOCK, max(mixing.BLOCK_FIRST, done))
        for place, byte in enumerate(part):
            if place and part[place - 1] in b" \t\n\x0b\x0c\r":
                begun = place
            contexts = [
                sum(b << (8 * k) for k, b in enumerate(reversed(part[max(0, place - 2) : place]))),
                sum(b << (8 * k) for k, b in enumerate(reversed(part[max(begun, place - 4) : place]))),
                sum(int(mixing._VALUES[b]) * pow(int(mixing._ROOT), k, 1 << 64) for k, b in enumerate(part[begun:place])) & mask,
            ]
            hashes = []
            for context, odd, bits in zip(contexts, mixing._ODD, (min(16, model.bits), model.bits, model.bits)):
                context ^= context >> 29
                hashes.append((((context * int(odd) + int(odd)) & mask) >> (64 - bits), (1 << bits) - 1))
            first = model.tree.first[byte]
            for step in range(first, first + model.tree.length[byte]):
                node, bit = int(model.tree.node[step]), int(model.tree.bit[step])
                a, b, c = (float(model.stretch[k][h ^ (node & most)]) / mixing.SCALE for k, (h, most) in enumerate(hashes))
                x = np.array([a, b, c, a * (b != 0), a * (c != 0), b * (c != 0)])
                chance = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights @ x)))))
                cost -= math.log(chance if bit else 1 - chance)
                teach += x * (bit - chance)
                done, size, left = done + 1, size + 1, left - 1
                if not left:
                    weights, teach, size = learned(teach, size), np.zeros(6), 0
                    left = min(mixing.BLOCK, max(mixing.BLOCK_FIRST, done))
        if size:
            weights = learned(teach, size)
    return cost


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return mixing.train(docs.filter("doc_id < 300"))


def test_given_documents_have_the_base_scores_of_the_definition(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    expected = base_scores(rows, lambda i: zlib.crc32(str(i).encode()) % 10 != 0)
    found = queries.queries()["op11_context_mixing"](spark, SF).collect()
    assert len(found) == len(rows)
    for r in found:
        n_tokens, n_known, total, base = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert r["score"] < 0
    held = [r for r in found if r["held_out"] and r["n_tokens"] > 20]
    assert np.median([r["bits_per_byte"] for r in held]) < 2.7
    assert np.corrcoef([r["score"] for r in held], [r["base_score"] for r in held])[0, 1] > 0.95


def test_costs_equal_a_plain_version(docs, model):
    texts = [lowered(r["text"]) for r in docs.filter("doc_id between 300 and 309").collect()]
    texts = [t[:3000] for t in texts] + [b"", b"A b", "é \x00\t".encode(), b"z" * 2000]
    got = list(mixing.cost_of(texts, model))
    for text, cost in zip(texts, got):
        assert math.isclose(cost, plain_cost(text, model), rel_tol=2e-4, abs_tol=1e-3)


def test_long_texts_go_segment_by_segment(model, monkeypatch):
    monkeypatch.setattr(mixing, "SEGMENT", 700)
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abc d", k=n)) for n in (0, 699, 700, 701, 2500, 10, 3)]
    for text, cost in zip(texts, mixing.cost_of(texts, model)):
        assert math.isclose(cost, plain_cost(text, model), rel_tol=2e-4)


def test_probabilities_of_all_continuations_add_up_to_one(model):
    for begun in (b"", b"th", b"de "):
        rest = [mixing.Decisions([begun + bytes([b])], model.tree, model.bits) for b in range(256)]
        total = 0.0
        for found in rest:
            inputs = mixing._inputs(found, model.stretch)
            total += math.exp(-mixing.mix(inputs, found.bit, model.weights, 0.0)[0])
        share = 1.0
        if begun:
            before = mixing.Decisions([begun], model.tree, model.bits)
            share = math.exp(-mixing.mix(mixing._inputs(before, model.stretch), before.bit, model.weights, 0.0)[0])
        assert math.isclose(total, share, rel_tol=1e-4)


def test_predictors_together_cost_less_than_each(docs, model):
    texts = [lowered(r["text"]) for r in docs.filter("doc_id between 500 and 540").collect()]
    together = sum(mixing.cost_of(texts, model))
    for k in range(3):
        alone = mixing.MixingModel(model.tree, model.bits, model.stretch, np.eye(6, dtype=np.float32)[k])
        assert together < sum(mixing.cost_of(texts, alone))


def test_tables_count_every_training_text(docs, model):
    texts = [lowered(r["text"]) for r in docs.filter("doc_id < 40").collect()] + [b"", b"  \n", b"x" * 50]
    counted = mixing.Counts(model.tree, 14)
    expected = [Counter() for _ in range(3)]
    for text in texts:
        counted.add(text)
        found = mixing.Decisions(mixing.segments(text), model.tree, 14)
        for k, slots in enumerate(found.slots()):
            expected[k].update(zip(slots.tolist(), found.bit.tolist()))
    tables = np.concatenate(counted.parts()).reshape(3, -1, 2)
    for k, seen in enumerate(expected):
        plain = np.zeros((1 << 14, 2))
        for (slot, bit), n in seen.items():
            plain[slot, bit] += n
        assert (tables[k] == plain).all()


def test_words_cut_by_a_segment_are_counted(model, monkeypatch):
    monkeypatch.setattr(mixing, "SEGMENT", 7)
    counted = mixing.Counts(model.tree, 12)
    counted.add(b"some longer words here")
    counted.parts()
    decisions = sum(int(model.tree.length[b]) for b in b"some longer words here\xff")
    assert [int(t.sum()) for t in counted.tables] == [decisions] * 3


def test_many_tables_are_summed_in_rounds(docs, monkeypatch):
    chosen = docs.filter("doc_id < 60")
    whole = mixing.train(chosen.coalesce(1))
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    parted = mixing.train(chosen.repartition(7))
    assert all((x == y).all() for x, y in zip(whole.stretch, parted.stretch))
    assert np.allclose(whole.weights, parted.weights, atol=1e-5)


def test_weights_adapt_within_a_text(model):
    found = mixing.Decisions([b"qx" * 4000 + b"\xff"], model.tree, model.bits)
    inputs = mixing._inputs(found, model.stretch)
    still = mixing.mix(inputs, found.bit, model.weights, 0.0)[0]
    assert mixing.mix(inputs, found.bit, model.weights, mixing.RATE)[0] < still


def test_nulls_empty_repeated_extra_columns_and_nothing_to_learn(frame, spark):
    rows = [
        (1, "Some words here", 1.0), (2, None, 1.0), (3, "", 1.0), (4, "some WORDS", 1.0), (4, "some WORDS", 1.0), (None, "here", 1.0),
        (5, " \n\t", 1.0), (6, "w" * 700_000, 1.0),
    ]
    df = frame(rows, SCHEMA + ", score double")
    got = mixing.score(df, F.col("doc_id") == 1).collect()
    expected = base_scores([(i, t) for i, t, _ in rows], lambda i: i == 1)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[r["doc_id"]][:3]
        assert math.isclose(r["base_score"], expected[r["doc_id"]][3], rel_tol=1e-9)
        assert r["learns"] == (r["doc_id"] == 1) and r["score"] < 0 and r["bits_per_byte"] > 0
    even = mixing.score(df, F.lit(None).cast("boolean")).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["base_score"]) < 1e-12 for r in even)
    assert math.isclose({r["doc_id"]: r["score"] for r in even}[2], -8 * math.log10(2), rel_tol=1e-6)
    assert mixing.score(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def test_first_weights_are_learned_on_all_training_texts(spark):
    long = "alpha beta gamma delta " * 500
    rows = [(long + chr(97 + n) * 40,) for n in range(6)] + [(f"short {n} text",) for n in range(400)]
    docs = spark.createDataFrame(rows, "text string")
    model = mixing.train(docs)
    counts = mixing.Counts(model.tree, model.bits)
    for (text,) in rows:
        counts.add(text.encode())
    flat = np.concatenate(counts.parts())
    sizes = [2 << b for b in mixing.table_bits(model.bits)]
    tables = [t.reshape(-1, 2).astype(np.float64) for t in np.split(flat, np.cumsum(sizes)[:-1])]
    weights, gradient, cases = model.weights.astype(np.float64), np.zeros(6), 0
    for (text,) in rows:
        found = mixing.Decisions(mixing.segments(text.encode()), model.tree, model.bits)
        logits = []
        for table, slots in zip(tables, found.slots()):
            left = table.copy()
            np.add.at(left, (slots, found.bit), -1.0)
            logits.append(mixing.stretched(left[slots, 0], left[slots, 1]))
        x = mixing.gated(logits).astype(np.float64)
        side = 2.0 * found.bit - 1
        gradient += x @ (side / (1 + np.exp(np.clip(side * (weights @ x), -30, 30))))
        cases += len(side)
    assert np.abs(gradient).max() < 1e-3 * cases


def test_long_texts_teach_the_first_weights(spark):
    long = spark.createDataFrame([("alpha beta gamma " * 700 + str(n),) for n in range(5)], "text string")
    assert not np.allclose(mixing.train(long).weights, [0.4] * 3 + [0.0] * 3, atol=1e-3)


def test_cases_are_those_of_every_decision_though_equal_ones_are_judged_once(model):
    texts = [lowered("Alpha beta, beta gamma " * 150 + "x" * n) for n in range(4)] + [b"", b"  \n", "é \x00\t".encode()]
    counts = mixing.Counts(model.tree, 14)
    for text in texts:
        counts.add(text)
    tables = np.concatenate(counts.parts()).reshape(3, -1, 2).astype(np.float32)
    judged = mixing.Judged(model.tree, 14, list(tables))
    expected = Counter()
    for text in texts:
        judged.add(text)
        found = mixing.Decisions(mixing.segments(text), model.tree, 14)
        logits = []
        for table, slots in zip(tables, found.slots()):
            left = table.copy()
            np.add.at(left, (slots, found.bit), -1.0)
            logits.append(mixing.stretched(left[slots, 0], left[slots, 1]).astype(int) * (2 * found.bit - 1))
        expected.update(zip(*(x.tolist() for x in logits)))
    levels = 241
    got = {
        (part - 120, int(case) // levels - 120, int(case) % levels - 120): int(n)
        for part, cases, times in judged.taken()
        for case, n in zip(cases, times)
    }
    assert got == dict(expected)
    assert list(judged.taken()) == []
    assert len(mixing.Contexts(mixing.segments(texts[0]), model.tree).distinct(apart=True)[2]) < 60


def test_counted_cases_are_as_many_rows_as_the_first_logit_has_values(docs, spark, monkeypatch):
    kept = []
    monkeypatch.setattr(mixing, "first_weights", lambda cases: kept.append(cases) or np.zeros(6, dtype=np.float32))
    mixing.train(docs.filter("doc_id < 40").repartition(3))
    parts = [r["part"] for r in kept[0].select("part").collect()]
    assert len(parts) == len(set(parts)) <= 241
