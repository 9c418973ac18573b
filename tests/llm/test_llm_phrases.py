from __future__ import annotations

import hashlib
import random

from tarmac.llm import phrases, queries

SCHEMA = "doc_id bigint, text string"


def brute_force(rows, window=50):
    """Per document: words, removed words, digest of the kept ones."""
    split = {i: (t or "").encode().split() for i, t in rows if i is not None}
    first = {}
    for i in sorted(split):
        for p in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][p : p + window]), i)
    out = {}
    for i, words in split.items():
        gone = set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_given_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.queries()["op3_repeated_passages"](spark, sf)) == brute_force(rows)


def test_overlapping_nested_and_periodic_passages(frame):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = [(100, " ".join(words)), (200, " ".join(words)), (150, "a " * 130), (160, "a " * 70), (170, "a b " * 60)]
    rows += [(175, "b a " * 55), (180, " ".join(words[10:60])), (181, " ".join(words[10:59]))]
    for i in range(60):  # pieces of the long text and of each other, in any order
        parts = []
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(0, 350)
            parts += words[a : a + rng.randrange(20, 140)] + [f"x{rng.randrange(9)}"] * rng.randrange(3)
        rows.append((rng.randrange(1, 99) * 1000 + i, " \n".join(parts)))
    rng.shuffle(rows)
    df = phrases.repeated_passages(frame(rows, SCHEMA), block_words=300)
    assert found(df) == brute_force(rows)
    texts = dict(rows)
    for r in df.collect():
        kept = phrases.kept_text(texts[r["doc_id"]], [(s["start"], s["stop"]) for s in r["removed"]])
        assert hashlib.sha256(kept.encode()).hexdigest() == r["kept_sha256"]


def test_nulls_empty_repeated_and_extra_columns(frame):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None, 0), (2, "", 0), (3, text, 1), (3, text, 1), (4, text + " end", 2), (None, text, 3), (5, " \t", 4)]
    df = phrases.repeated_passages(frame(rows, "doc_id bigint, text string, n_words int"))
    got = sorted(((r["doc_id"] or 0), r["n_words"], r["n_removed"]) for r in df.collect())
    assert got == [(0, 80, 0), (1, 0, 0), (2, 0, 0), (3, 80, 0), (3, 80, 0), (4, 81, 80), (5, 0, 0)]


def test_empty_table(spark):
    assert phrases.repeated_passages(spark.createDataFrame([], SCHEMA)).collect() == []
