from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tarmac.llm import queries, secrets

SCHEMA = "doc_id bigint, text string"


def texts(count, seed=4):
    rng = random.Random(seed)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    kinds = [
        lambda: (f"password={hexa(18)}", 1), lambda: (key(), 1), lambda: (f'token = "{hexa(40)}"', 1),
        lambda: (f"bob.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", 0),
        lambda: (".".join(str(rng.randrange(100, 255)) for _ in range(4)), 0),
        lambda: (str(rng.randrange(10**15, 10**16)), 0),
        lambda: (f"http://www.example.com/page{rng.randrange(9)}/index.html", 0),
    ]
    out = []
    for i in range(count):
        value, label = rng.choice(kinds)()
        out.append((i, f"some words before {value} and after", label))
    return out


def test_forest_tells_secrets_from_false_findings(frame):
    rows = texts(400)
    df = secrets.scan(frame([r[:2] for r in rows], SCHEMA))
    got = {r["doc_id"]: r["is_secret"] for r in df.collect()}
    assert got == {i: bool(label) for i, _, label in rows}


def test_labelled_findings_decide(frame):
    rows = [(i, f"order A{i:03d}-77{i % 10}-XYZW-{i * 37} sent", i % 2) for i in range(200)]
    docs = frame([r[:2] for r in rows], SCHEMA)
    # By their labels, findings with a long last group are secrets.
    labels = frame([(i, 1, int(i * 37 >= 1000)) for i, _, _ in rows], "doc_id bigint, word_pos int, label int")
    got = {r["doc_id"]: r["is_secret"] for r in secrets.scan(docs, labelled=labels).collect()}
    assert sum(got[i] == (i * 37 >= 1000) for i in got) > 0.95 * len(got) and len(got) == 200


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.queries()["op9_secret_scan"](spark, sf).collect()


    planted = re.compile(r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{10,}|token = \"[0-9a-f]{32,}")
    with_secret = {i for i, t in docs.items() if planted.search(t)}
    assert {r["doc_id"] for r in rows if r["is_secret"]} == with_secret
    assert any(not r["is_secret"] for r in rows)


def test_nulls_empty_repeated_and_long_texts(frame, spark):
    rows = [
        (1, None, "v"), (2, "", "v"), (3, "password=abc123def456abc123", "v"), (3, "password=abc123def456abc123", "v"),
        (None, 'x token: "abcdef0123456789abcdef" y', "v"), (5, "word " * 50_000 + "0123456789abcdef0123", "v"), (6, "= : 1", "v"),
    ]
    df = secrets.scan(frame(rows, "doc_id bigint, text string, value string"))
    got = sorted((r["doc_id"] or 0, r["word_pos"], r["name"], r["score"]) for r in df.collect())
    assert got == [(0, 2, "", 1.0), (3, 0, "password", 1.0), (3, 0, "password", 1.0), (5, 50_000, "", 0.0)]
    assert secrets.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rare_secrets_stay_in_a_bounded_sample(frame):
    rows = [(i, f"on 10.{i % 200}.{i // 200}.{i % 250}:8080 we saw", 0) for i in range(3000)]
    rows += [(3000 + i, text, label) for i, text, label in texts(60, seed=9) if label]
    df = secrets.scan(frame([r[:2] for r in rows], SCHEMA), sample=60)
    got = {r["doc_id"]: r["is_secret"] for r in df.collect()}
    assert got == {i: bool(label) for i, _, label in rows}


def test_words_assigned_to_a_name_are_candidates(frame):
    found = [
        ("password: Sw0rdf1sh", 1, ""), ('password = "correcthorsebattery"', 2, ""), ("DB_PASSWORD=hunter2abc", 0, "DB_PASSWORD"),
        ("my-token := abcdefgh", 2, ""), ('{"client_secret": "abcdefgh"}', 1, ""), ("dbPassword=abcdefgh", 0, "dbPassword"),
        ("spring.datasource.password=abcdefgh", 0, "password"), ('pwd ="abcdefgh"', 1, ""), ("auth: Bearer abcdefgh", 2, ""),
    ]
    lost = ["password: short", "the password hunters said", "see also: correcthorsebattery", "keynote=abcdefgh", "a password is = to"]
    rows = [(i, text) for i, (text, _, _) in enumerate(found)] + [(100 + i, text) for i, text in enumerate(lost)]
    got = {(r["doc_id"], r["word_pos"], r["name"]) for r in secrets.scan(frame(rows, SCHEMA)).collect()}
    assert got == {(i, at, name) for i, (_, at, name) in enumerate(found)}


def test_the_forest_judges_words_without_digits(frame):
    rows = [(i, f"{'password' if i % 2 else 'db_token'}: {'correct' if i % 3 else 'xkqzvwpj'}horse{'abcdefgh'[i % 8]} x") for i in range(240)]
    labels = frame([(i, 1, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, word_pos int, label int")
    got = {r["doc_id"]: r["is_secret"] for r in secrets.scan(frame(rows, SCHEMA), labelled=labels).collect()}
    assert got == {i: i % 3 == 0 for i, _ in rows}


def test_features_from_the_corpus_equal_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    held = [set(re.findall("[a-z]{3,}", t)) for t in lower]
    pairs, used = Counter(), Counter()
    for words in held:
        used.update(words)
        for w in words:
            pairs.update(w[i : i + 2] for i in range(len(w) - 1))
    letters = "abcdefghijklmnopqrstuvwxyz"
    first = {a: sum(pairs[a + b] for b in letters) for a in letters}
    logp = {a + b: math.log((pairs[a + b] + 1) / (first[a] + 26)) for a in letters for b in letters}
    assert secrets.letter_pairs(docs, "text") == pytest.approx(logp)
    found = secrets.candidates(docs, "doc_id", "text")
    found = secrets._with_known(found, secrets.known_words(docs, found, "text"))
    rows = secrets.described(found, logp).collect()
    assert len(rows) > 50
    for r in rows:
        value = re.sub("[A-Z]", lambda m: m[0].lower(), r["value"])
        known = sum(len(w) for w in re.findall("[a-z]{3,}", value) if used[w] >= secrets.LEAST_DOCUMENTS)
        assert r["dictionary_share"] == pytest.approx(known / len(value))
        told = [logp[w[i : i + 2]] for w in re.findall("[a-z]{2,}", value) for i in range(len(w) - 1)]
        assert r["transition_logp"] == pytest.approx(sum(told) / len(told) if told else -math.log(26))


def test_passwords_in_addresses_are_secrets_and_plain_addresses_are_not(frame):
    rows = texts(300)
    more = [
        (1000, "use postgres://admin:hunter2abcXYZ99@db.example.com:5432/prod now", 1), (1001, "https://bob:Zx81kQpL0vTr@git.example.com/r.git", 1),
        (1002, "see https://git.example.com/bob/r1234567.git", 0),
    ]
    found = secrets.scan(frame([r[:2] for r in rows + more], SCHEMA)).collect()
    assert {r["doc_id"]: r["is_secret"] for r in found if r["doc_id"] >= 1000} == {i: bool(label) for i, _, label in more}
    assert all("hunter" not in str(r.asDict()) for r in found)


def test_a_text_alone_is_judged_by_form(frame):
    harmless = "order 4711-0815-2342-9999 at 2024-01-01T10:00:00 by bob.12@mail.example.com"
    assert not any(r["is_secret"] for r in secrets.scan(frame([(1, harmless)], SCHEMA)).collect())
    alone = secrets.scan(frame([(1, "password=0a1b2c3d4e5f60718293 and postgres://a:bcdefgh@h/x")], SCHEMA)).collect()
    assert [r["is_secret"] for r in alone] == [True, True]


def test_no_value_can_be_told_from_the_result(frame):
    found = secrets.scan(frame([(1, "password=abcd1234 token=0123456789abcdef0123456789abcdef")], SCHEMA)).collect()
    assert {r["masked"] for r in found} == {"...", "0123..."} and "value_sha256" not in found[0].asDict()
