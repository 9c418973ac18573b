from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tarmac.llm import exact

SCHEMA = "doc_id bigint, text string"


def digest_rows(count):
    raw = b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(count))
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, 32)


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 20_000])
def test_perfect_hash_gives_every_member_its_own_slot(count):
    digests = digest_rows(count)
    sizes, bitmaps, slots = exact.build_hash(digests)
    assert sorted(slots) == list(range(count))
    assert (exact.find_slots(sizes, bitmaps, digests) == slots).all()


def test_digests_that_no_level_parts_take_the_last_slots():
    twins = np.zeros((3, 32), dtype=np.uint8)
    twins[1, 0] = twins[1, 16] = 7  # the halves that are hashed are equal: 0 xor 0 and 7 xor 7
    twins[2, 5] = 9
    slots = exact.build_hash(twins)[2]
    assert sorted(slots) == [0, 1, 2] and slots[2] == 0


def expected(rows):
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [j for j in by_text[t or ""] if j is not None]
        keep = max(ids, default=None)
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        out.append((i, keep, len(by_text[t or ""]), i == keep, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


@pytest.mark.parametrize("history", [None, -1, 0, 40, 10**9])
def test_groups_do_not_depend_on_where_the_history_ends(frame, history):
    rng = random.Random(3)
    rows = [(i, f"text {rng.randrange(60)}") for i in range(150)]
    rows += [(150, None), (151, ""), (152, "x" * 300_000), (153, "x" * 300_000), (5, rows[5][1])]
    rows += [(None, "text 1"), (None, "alone"), (None, "alone")]
    df = exact.exact_duplicates(frame(rows, SCHEMA), history_up_to=history, digests_per_shard=7)
    assert found(df) == expected(rows)


def test_members_are_told_from_nonmembers(frame):
    rows = [(1, "a"), (2, "b"), (11, "b"), (12, "c"), (13, "c")]
    df = exact.exact_duplicates(frame(rows, SCHEMA), history_up_to=5)
    assert {r["doc_id"]: r["in_history"] for r in df.collect()} == {1: True, 2: True, 11: True, 12: False, 13: False}


def test_one_text_everywhere_extra_columns_and_empty_table(frame, spark):
    rows = [(i, "same", i, "d") for i in range(200)]
    df = exact.exact_duplicates(frame(rows, "doc_id bigint, text string, id int, digest string"))
    assert {(r["keep_id"], r["group_size"]) for r in df.collect()} == {(199, 200)}
    assert df.filter("kept").count() == 1
    assert exact.exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("history", [None, -100, -3, 10**9])
def test_negative_ids(frame, history):
    rows = [(-9, "a"), (-4, "a"), (-1, "b"), (-7, "c"), (5, "c"), (None, "a"), (None, "d"), (-(2**63), "e"), (2**63 - 1, "f")]
    assert found(exact.exact_duplicates(frame(rows, SCHEMA), history_up_to=history)) == expected(rows)
