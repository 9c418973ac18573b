from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import minhash, queries
from tarmac.llm.components import components

SCHEMA = "doc_id bigint, text string"


def shingles(text, size=5):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(rows, percent=85):
    """component per row, by comparing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_shingle = {}
    for i in sorted(sets):
        met = set()
        for s in sets[i]:
            met.update(by_shingle.setdefault(s, []))
            by_shingle[s].append(i)
        for j in met:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_given_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    result = queries.queries()["op1_minhash_dedup"](spark, sf)
    expected = brute_force(rows)
    assert found(result) == expected
    assert {r["doc_id"] for r in result.filter("kept").collect()} == {c for _, c in expected.values()}


@pytest.mark.parametrize(("pivots", "few"), [((16,), 64), ((2, 4), 0), ((), 0)])
def test_chains_and_hubs_whose_members_are_not_all_alike(frame, pivots, few):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows, words = [], list(base)
    for i in range(12):  # a chain: each differs from the one before, the ends differ much
        rows.append((100 + i, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(200)] = f"c{i}{rng.random()}"
    hub = [f"h{i}" for i in range(150)]
    rows.append((55, " ".join(hub)))  # a hub that is not the smallest id
    for i in range(30):
        copy = list(hub)
        copy[rng.randrange(150)] = f"x{i}"
        copy[rng.randrange(150)] = f"y{i}"
        rows.append((20 + i if i < 15 else 300 + i, " ".join(copy)))
    rng.shuffle(rows)
    df = minhash.near_duplicates(frame(rows, SCHEMA), pivots=pivots, few=few)
    assert found(df) == brute_force(rows)


def test_nulls_empty_short_repeated_and_extra_columns(frame):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, " \t\n ", "c"), (4, "One two", "d"), (5, "one TWO", "e"),
        (6, text, "f"), (7, text.upper(), "g"), (7, text.upper(), "g"), (None, text, "h"), (None, "z", "i"),
        (9, "Été", "j"), (10, "été", "k"),
    ]
    df = minhash.near_duplicates(frame(rows, "doc_id bigint, text string, component_id string"))
    got = sorted(
        ((r["doc_id"] if r["doc_id"] is not None else -1), r["n_shingles"], r["component_id"], r["kept"])
        for r in df.filter("doc_id is not null").collect()
    )
    assert got == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 46, 6, True), (7, 46, 6, False), (7, 46, 6, False), (9, 1, 9, True), (10, 1, 10, True),
    ]
    lone = df.filter("doc_id is null").orderBy(F.desc("n_shingles")).collect()
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in lone] == [(46, 6, False), (1, None, False)]


def test_empty_table(frame, spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_min_max_values_estimate_similarity():
    rng = random.Random(3)
    words = [str(rng.random()) for _ in range(1000)]
    a = minhash.shingle_set(" ".join(words[:900]).encode())
    b = minhash.shingle_set(" ".join(words[100:]).encode())
    agree = (minhash.min_max(a) == minhash.min_max(b)).mean()
    assert abs(agree - 796 / 996) < 0.12


def test_components_of_long_chains(frame):
    edges = [(i, i + 1) for i in range(100)] + [(200, 200), (301, 300), (301, 300), (None, 4)]
    got = {r["id"]: r["component"] for r in components(frame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(101)}, 300: 300, 301: 300}


@pytest.mark.parametrize(("percent", "size", "count"), [(85, 6, 32), (80, 5, 38), (75, 4, 48), (50, 2, 96)])
def test_bands_are_laid_out_for_the_threshold(percent, size, count):
    assert (minhash.band_size(percent), minhash.band_count(size)) == (size, count)
    assert (1 - (percent / 100) ** size) ** count < 1e-6
    signature = minhash.min_max(minhash.shingle_set(b"one two three four five six seven"))
    assert len(set(minhash.band_keys(signature, size))) == count


def test_a_crowd_around_the_threshold_emits_few_candidates(frame, monkeypatch):
    """Thousands of near copies that mostly miss the threshold: pairs are judged, few are written, none is lost."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(700):
        words = list(base)
        for _ in range(rng.choice([1, 3, 4, 5])):
            words[rng.randrange(150)] = f"x{i}.{rng.random()}"
        rows.append((i, " ".join(words)))
    written = {}
    keep = minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda df, name: written.setdefault(name, []).append(keep(df, name)) or written[name][-1])
    found_components = found(minhash.near_duplicates(frame(rows, SCHEMA), percent=80))
    assert found_components == brute_force(rows, percent=80)
    pairs = sum(df.count() for df in written["minhash-pairs"])
    assert pairs < 40 * len(rows)


def test_sketches_are_looked_up_once_for_a_document(frame):
    """However many buckets a document is in, the join has one row for it."""
    members = frame([(key, i, 0) for i in range(5) for key in range(32)], "key bigint, id bigint, component bigint")
    sketches = frame([(i, 9, [i]) for i in range(9)], "id bigint, n_shingles bigint, bits array<bigint>")
    df = minhash._sketched(members, sketches)
    got = sorted((r["id"], r["key"], r["component"], r["n_shingles"], r["bits"]) for r in df.collect())
    assert got == [(i, key, 0, 9, [i]) for i in range(5) for key in range(32)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join Inner") < plan.index("Aggregate")


def test_near_copies_are_in_a_bucket_once_and_cut_to_their_prefix(frame, monkeypatch):
    """Near copies meet in most of their bands: no row for each band, and no row for each shingle, is joined."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.choice([1, 4, 6])):
            words[rng.randrange(200)] = f"x{i}.{rng.random()}"
        rows.append((i, " ".join(words)))
    written = {}
    keep = minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda df, name: written.setdefault(name, []).append(keep(df, name)) or written[name][-1])
    assert found(minhash.near_duplicates(frame(rows, SCHEMA), few=0)) == brute_force(rows)
    assert written["minhash-buckets"][0].count() < 15 * len(rows)  # of 32 bands
    cut = minhash._prefixes(written["minhash-crowded"][-1], written["minhash-sets"][0], 85)
    generated = cut.count()
    assert generated < 0.17 * written["minhash-sets"][0].selectExpr("sum(size(shingles))").first()[0]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join Inner")


def test_slot_counts_reach_the_driver_as_a_byte_each(spark):
    counts = np.arange(1, 300_000)
    levels = minhash._levels(counts).astype(int)
    assert (levels[:128] == counts[:128]).all() and (np.diff(levels) >= 0).all() and levels[-1] > 200
    met = [[int(np.int64(np.uint64(n % 3000 << 44).view(np.int64))) for n in range(1000 * k, 1000 * k + 2500)] for k in range(3)]
    sets = spark.createDataFrame([(k, s) for k, s in enumerate(met)], "id bigint, shingles array<bigint>")
    rows = minhash._slot_levels(sets).collect()
    assert [(r["part"], len(r["levels"])) for r in rows] == [(0, 1 << 16)]
    found = np.frombuffer(rows[0]["levels"], dtype=np.uint8)
    expected = np.bincount([n % 3000 for k in range(3) for n in range(1000 * k, 1000 * k + 2500)], minlength=1 << 16)
    assert (found == expected).all()
