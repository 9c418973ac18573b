from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tarmac.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def odd_texts():
    rng = random.Random(1)
    letters = "abc ABC 019\n\t\r 　\u0085\x1c\x1f\x0b'sS'llé日本🙂́²Ⅷ٣_-#​᠎﻿\0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [
        *texts, "", "a" * 5000, "ab" * 3000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", " " * 100 + "x",
        " a  b ", "a \u00a0b \u2003c", "x\u2003 y", "one\n two \nthree", "word. Word, (word) 'll I'll.", "日" * 1000, "é" * 777, "aaa" * 50 + "!" * 333, "<|endoftext", "I'll we've x'S",
    ]


def lexicon(vocabulary, tmp_path, words):
    path = tmp_path / "lexicon.bin"
    ordered = sorted(words)
    path.write_bytes(bpe.compile_lexicon(dict(zip(ordered, vocabulary.merge(ordered), strict=True))))
    return bpe.Lexicon(str(path)), ordered


@pytest.mark.parametrize("with_lexicon", [False, True])
def test_ids_and_texts_equal_the_library(reference, vocabulary, tmp_path, with_lexicon):
    texts = odd_texts()
    words = {w.encode() for t in texts[:300] for w in vocabulary.pattern.findall(t) if len(w) < 9}
    coder = bpe.Encoder(vocabulary, lexicon(vocabulary, tmp_path, words)[0] if with_lexicon else None)
    rows, ids = coder.encode(texts)
    for i, expected in enumerate(reference.encode_batch(texts, add_special_tokens=False)):
        got = ids[rows[i] : rows[i + 1]].tolist()
        assert got == expected.ids
        decoded = b"".join(vocabulary.token_bytes[k] for k in got).decode("utf-8", "replace")
        assert decoded == reference.decode(expected.ids, skip_special_tokens=False)


def test_lexicon_holds_its_words_and_no_others(vocabulary, tmp_path):
    words = {b"a", b"ab", b"abc", b" the", b" there", b"here", "é".encode(), b"xbc"}
    compiled, ordered = lexicon(vocabulary, tmp_path, words)
    assert compiled.find(ordered).tolist() == list(range(len(ordered)))
    assert compiled.find([b"", b"b", b"th", b" ther", b"abcd", b"x" * 99]).tolist() == [-1] * 6
    assert len(compiled.finals) < sum(map(len, ordered))  # ends are shared


def test_empty_lexicon(vocabulary, tmp_path):
    compiled, _ = lexicon(vocabulary, tmp_path, set())
    assert compiled.find([b"a", b""]).tolist() == [-1, -1]


def test_words_are_forgotten_in_time(reference, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_HELD", 5)
    coder = bpe.Encoder(vocabulary, None)
    for text in ("one two three four five six", "one two seven eight", "six one"):
        assert coder.encode([text])[1].tolist() == reference.encode(text).ids
    assert len(coder.chunks.number) < 10


def test_given_documents_equal_the_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.queries()["op5_bpe_round_trip"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for doc_id, text in docs:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        decoded = reference.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), decoded)]
        assert got[doc_id] == (len(ids), *digests)
    assert len(got) == len(docs)


def test_nulls_repeated_rows_extra_columns_and_empty_table(frame, spark):
    rows = [(1, None, [1]), (2, "", [2]), (3, "hello there", [3]), (3, "hello there", [3]), (None, "x" * 200_000, [4])]
    df = bpe.round_trip(frame(rows, "doc_id bigint, text string, ids array<int>"), PATH, lexicon_words=3)
    got = sorted((r["doc_id"] or 0, len(r["ids"]), r["decoded"][:11]) for r in df.collect())
    assert [g for g in got if g[0]] == [(1, 0, ""), (2, 0, ""), (3, 2, "hello there"), (3, 2, "hello there")]
    assert got[0][2] == "x" * 11
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip(empty, PATH).collect() == []


def test_decoding_foreign_ids(frame, spark):
    coder = bpe.codec(spark, PATH)
    df = frame([([15496, 50256, 999_999, -4, None],), (None,), ([],), ([165],)], "ids array<int>")
    assert sorted(r[0] for r in df.select(coder.decode(df["ids"])).collect()) == ["", "", "Hello<|endoftext|>", "�"]


def test_long_overlapping_merges(vocabulary, reference):
    for word in ("a" * 999, "aab" * 333, "ha" * 100 + "h"):
        assert np.concatenate(vocabulary.merge([word.encode()])).tolist() == reference.encode(word).ids


def test_texts_are_encoded_few_bytes_at_a_time(monkeypatch):
    monkeypatch.setattr(bpe, "_BYTES_AT_ONCE", 10)
    monkeypatch.setattr(bpe, "_TEXTS_AT_ONCE", 3)
    texts = pa.array(["four", "five5", "x", "é" * 40, None, "", "", "", "", "last"])
    assert list(bpe._slices(texts)) == [(0, 3), (3, 1), (4, 3), (7, 3)]
    assert list(bpe._slices(texts.slice(3, 2))) == [(0, 1), (1, 1)]
    assert list(bpe._slices(pa.array([], pa.string()))) == []


def test_rows_decode_together(vocabulary):
    rows, ids = bpe.Encoder(vocabulary, None).encode(["", "héllo", None, "日本"])
    assert bpe.decode_rows(vocabulary.tokens, rows, ids).to_pylist() == ["", "héllo", "", "日本"]
    assert bpe.decode_rows(vocabulary.tokens, rows[1:3], ids).to_pylist() == ["héllo"]
    foreign = np.array([15496, -1, 10**6, 165, 15496])
    assert bpe.decode_rows(vocabulary.tokens, np.array([0, 3, 4, 5]), foreign).to_pylist() == ["Hello", "�", "Hello"]
    assert bpe.decode_rows(vocabulary.tokens, np.array([0, 2]), foreign[1:3]).to_pylist() == [""]
