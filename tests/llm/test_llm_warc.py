from __future__ import annotations

import glob
import hashlib
import random

import pytest

from tarmac.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least=100):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= least and i is not None and i > first[html or ""]
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=repr)


def found(df):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


ROWS = [
    (5, "http://b.example.com/x", "é" * 60), (3, "http://b.example.com/x?q#f", "é" * 60), (9, None, None), (8, "http://a", ""),
    (7, "https://A.example.com", "short"), (6, "x", "short"), (4, "http://c/\r\nWARC-Type: fake", "WARC/1.1\r\n\r\n" * 20),
    (2, "http://c/", "WARC/1.1\r\n\r\n" * 20), (5, "http://b.example.com/x", "é" * 60), (None, "http://n/", "é" * 60),
    (1, "http://l/", "long " * 100_000), (10, "http://z/", "x" * 100), (11, "http://z/", "x" * 100), (12, "http://z/", "\0\n\r"),
]


def test_round_trip_of_odd_pages(frame):
    df = warc.archive_and_index(frame([(*r, "a", 1) for r in ROWS], SCHEMA + ", digest string, first int"))
    assert found(df) == expected(ROWS)


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(queries.queries()["op10_warc"](spark, sf)) == expected(rows)


def test_archives_parse_and_are_cut(frame, tmp_path):
    rows = [(i, f"http://h{i % 3}/", f"page {i} " * 50) for i in range(200)]
    warc.write_archives(frame(rows, SCHEMA), str(tmp_path / "w"), archive_bytes=20_000)
    files = glob.glob(f"{tmp_path}/w/*.txt")
    assert len(files) > 3
    payloads = []
    for name in files:
        with open(name, "rb") as file:
            data = file.read()
        for offset, length, headers, block in warc.parse_archive(data):
            assert data[offset : offset + 8] == b"WARC/1.1" and headers["warc-type"] == "response"
            assert data[offset : offset + length].endswith(block + b"\r\n\r\n")
            payloads.append(block.partition(b"\r\n\r\n")[2].decode())
    assert sorted(payloads) == sorted(r[2] for r in rows)


def test_damaged_archives_are_refused():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r[3] for r in warc.parse_archive(good * 2)] == [b"abc", b"abc"]
    for bad in (good[:-1], good + b"x", good.replace(b"3", b"4")):
        with pytest.raises(ValueError):
            list(warc.parse_archive(bad))


def row(key, time, page):
    return ("r", key, time, page, None, 0, "", "response", None, 0, 0)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merges_any_number_of_runs(k):
    rng = random.Random(k)
    runs = [
        sorted((row(rng.choice("abc"), str(rng.randrange(4)), rng.choice([None, 1, 2, 3])) for _ in range(rng.randrange(30))), key=warc._order)
        for _ in range(k)
    ]
    merged = list(warc.LoserTree([iter(r) for r in runs]))
    assert merged == sorted((x for r in runs for x in r), key=warc._order)


def test_histories_are_globally_ordered(frame):
    rows = [(i, "http://hot.example.com/" if i % 3 else f"http://h{i}.org/p", f"page {i}") for i in range(300)]
    captures = warc.stored(warc.archive_and_index(frame(rows, SCHEMA)).drop("key_range", "position"), "test")
    merged = warc.capture_histories(captures, range_rows=40).orderBy("key_range", "position").collect()
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in merged]
    assert keys == sorted(keys) and len(keys) == 300
    assert len({r["key_range"] for r in merged if r["url_key"] == "com,example,hot)/"}) > 1


def test_empty_table(spark):
    assert warc.archive_and_index(spark.createDataFrame([], SCHEMA)).collect() == []
