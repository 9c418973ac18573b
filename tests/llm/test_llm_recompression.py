from __future__ import annotations

import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from tarmac.llm import queries, recompression

SCHEMA = "doc_id bigint, text string"


def all_runs(words):
    """Every run by the definition: stretches of agreement for each period, smallest period of equal ends."""
    n, found = len(words), {}
    codes = np.array([hash(w) for w in words], dtype=np.int64)
    for q in range(1, n // 3 + 1):
        agree = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        bounds = np.flatnonzero(agree[1:] != agree[:-1])
        for start, stop in zip(bounds[::2].tolist(), bounds[1::2].tolist()):
            length = stop - start + q
            if length >= max(24, 3 * q):
                found.setdefault((start, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def analysed(words):
    runs = sorted(all_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = set()
    for start, length, q in runs:
        dropped.update(range(start + q, start + length))
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return len(words), runs, best, kept


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_given_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for doc_id, text in rows:
        n, runs, best, kept = analysed(planted(doc_id, text))
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        milli = 1000 * best[1] // best[2] if best else None
        expected[doc_id] = (n, len(runs), *(best or (None,) * 3), milli, sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.queries()["op12_periodic_runs"](spark, sf).collect()}
    assert got == expected
    assert sum(e[1] > 0 for e in expected.values()) > 20


def test_random_periodic_texts_equal_brute_force():
    rng = random.Random(2)
    documents = []
    for _ in range(150):
        words = []
        while len(words) < rng.randrange(1, 300):
            unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 30))]
            words += (unit * rng.randrange(1, 12))[: rng.randrange(1, 200)]
        documents.append(words)
    documents += [[], [1], [7] * 23, [7] * 24, [7] * 1000, [1, 2] * 11 + [1], [1, 2] * 12, [*range(8)] * 3, [*range(9)] * 3]
    got = recompression.runs_of([np.array(d, dtype=np.int64) for d in documents])
    for words, runs in zip(documents, got):
        assert runs == sorted(all_runs(words), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("forward", [True, False])
def test_extensions_are_exact(forward):
    rng = np.random.default_rng(4)
    body = np.concatenate([rng.integers(0, 3, 500), np.tile([0, 1, 1, 2], 100), np.zeros(300, dtype=np.int64), rng.integers(0, 2, 300)])
    text = np.concatenate([[10], body, [11]])
    grammar = recompression.Grammar(text)
    a, b = rng.integers(1, len(text) - 1, (2, 3000))
    a, b = a[a != b], b[a != b]
    got = grammar.extend(a, b, forward)
    for x, y, n in zip(a.tolist(), b.tolist(), got.tolist()):
        step, at, expected = (1, 0, 0) if forward else (-1, -1, 0)
        while text[x + at + step * expected] == text[y + at + step * expected]:
            expected += 1
        assert n == expected
    # A long stretch takes few levels.
    assert len(recompression.Grammar(np.concatenate([[3], np.tile([0, 1], 5000), [4]])).symbols) < 8


def test_candidates_in_parts_and_long_texts(monkeypatch):
    rng = np.random.default_rng(5)
    words = np.concatenate([rng.integers(0, 1000, 30_000), np.tile(rng.integers(0, 1000, 700), 8)[:5000], rng.integers(0, 9, 40)])
    whole = recompression.runs_of([words])
    assert [(length >= 5000, q) for _, length, q in whole[0]] == [(True, 700)]
    monkeypatch.setattr(recompression, "CANDIDATES", 1000)
    assert recompression.runs_of([words]) == whole


def test_nulls_empty_repeated_and_extra_columns(frame, spark, monkeypatch):
    rows = [
        (1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a b " * 20, 0), (4, "a b " * 20, 0), (None, "x " * 30, 0), (5, "é é " * 24, 0),
    ]
    df = frame(rows, SCHEMA + ", runs int")
    for words in (recompression.BATCH_WORDS, 3):
        monkeypatch.setattr(recompression, "BATCH_WORDS", words)
        found = recompression.periodic_runs(df).collect()
        got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found), key=repr)
        twice = (4, 40, [(0, 40, 2)], "a b")
        assert got == [
            (0, 30, [(0, 30, 1)], "x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), twice, twice, (5, 24, [(0, 24, 1)], "é é"),
        ]
        assert all((r["strongest"] is None) == (not r["runs"]) for r in found)
    assert recompression.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ties_take_the_smallest_start_then_period():
    assert recompression.strongest([(0, 30, 10), (40, 60, 20), (200, 31, 10)]) == (200, 31, 10)
    assert recompression.strongest([(5, 30, 10), (5, 60, 20)]) == (5, 30, 10)
    assert recompression.strongest([]) is None
