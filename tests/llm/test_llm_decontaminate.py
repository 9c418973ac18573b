from __future__ import annotations

import random
import re

from tarmac.llm import decontaminate, queries

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def run(frame, docs, items):
    found = decontaminate.contaminated(frame(docs, DOCS), frame(items, ITEMS))
    return {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in found.collect()}


PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TYPES = {"<number>", "<name>", "<unit>"}


def tokens(text):
    """(template, plain, raw) word by word, by rules written anew."""
    raw = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]

    def bare(word):
        cut = word.rstrip(PUNCT)
        return (cut if cut and cut[-1].isalnum() else word).lower()

    kinds = []
    for i, word in enumerate(raw):
        before = raw[i - 1] if i else ""
        number_before = bool(i) and kinds[-1] == "<number>"
        if re.search("[0-9]", word):
            kinds.append("<number>")
        elif i and word[0].isupper() and (number_before or before[-1].islower() or before[-1] in ",;"):
            kinds.append("<name>")
        elif number_before and word.rstrip(PUNCT) in decontaminate.UNITS:
            kinds.append("<unit>")
        else:
            kinds.append(bare(word))
    return kinds, [bare(w) for w in raw], raw


def brute_force(docs, items, percent=50, run_words=13):
    """(doc, item) -> (item words, covered, longest run, reparameterised), comparing words place by place."""
    found = {}
    parsed = [(i, *tokens(t)) for i, t in docs if i is not None and t]
    starts = {}
    for n in {min(8, len(tokens(t)[0])) for _, t in items if t}:
        for i, kinds, flat, _ in parsed:
            for at in range(len(kinds) - n + 1):
                for form, words in ((False, kinds), (True, flat)):
                    starts.setdefault((form, tuple(words[at : at + n])), set()).add((i, at))
    texts = {i: (kinds, flat, raw) for i, kinds, flat, raw in parsed}
    for item, text in items:
        kinds, flat, raw = tokens(text or "")
        if item is None or len(kinds) < 5:
            continue
        n = min(8, len(kinds))
        hits = set()
        for pos in range(len(kinds) - n + 1):
            hits |= {(i, at - pos, pos, True) for i, at in starts.get((True, tuple(flat[pos : pos + n])), ())}
            literals = sum(k not in TYPES for k in kinds[pos : pos + n])
            if min(4, n) <= literals < n:
                hits |= {(i, at - pos, pos, False) for i, at in starts.get((False, tuple(kinds[pos : pos + n])), ())}
        for doc in {h[0] for h in hits}:
            covered, longest = {}, 0
            for shift in {h[1] for h in hits if h[0] == doc}:
                here = [h for h in hits if h[:2] == (doc, shift)]
                given = texts[doc][2]
                values = {}
                slots = {h[2]: [w for w in range(h[2], h[2] + n) if kinds[w] in TYPES] for h in here if not h[3]}
                for places in slots.values():
                    for w in places:
                        values.setdefault(raw[w], set()).add(given[w + shift])
                for _, _, pos, is_plain in here:
                    if not is_plain and any(len(values[raw[w]]) > 1 for w in slots[pos]):
                        continue
                    changed = not is_plain and any(raw[w] != given[w + shift] for w in slots[pos])
                    for w in range(pos, pos + n):
                        covered[w] = covered.get(w, True) and changed
                plain = sorted(h[2] for h in here if h[3])
                run = 0
                for k, pos in enumerate(plain):
                    run = run + 1 if k and plain[k - 1] == pos - 1 else n
                    longest = max(longest, run)
            if covered and (100 * len(covered) >= percent * len(kinds) or longest >= run_words):
                found[doc, item] = (len(kinds), len(covered), longest, any(covered.values()))
    return found


def judged(df):
    return {(r["doc_id"], r["item_id"]): (r["item_words"], r["covered_words"], r["longest_run"], r["reparameterised"]) for r in df.collect()}


def test_given_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (
        [tuple(r)[:2] for r in spark.read.parquet(f"{sf}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    expected = brute_force(docs, items)
    assert judged(queries.queries()["op2_decontaminate"](spark, sf)) == expected
    assert len(expected) > 10


def test_made_up_questions_equal_brute_force(frame):
    rng = random.Random(6)
    stock = "take sell eat then 5 12 km apples pears Paris Berlin, to and 3 kg of Rome; the price 7 dollars in May".split()

    def text(n):
        return " ".join(rng.choice(stock) for _ in range(n))

    items = [(i, text(rng.choice([5, 6, 9, 20, 40]))) for i in range(25)]
    docs = []
    for d in range(60):
        base = rng.choice(items)[1].split()
        at = rng.randrange(max(1, len(base) - 6))
        part = base[at : at + rng.randrange(5, 30)] if rng.random() < 0.5 else list(base)
        swap = {w: rng.choice(["8", "9", "x", "Bonn"]) for w in ("5", "12", "Paris", "7") if rng.random() < 0.4}
        part = [swap.get(w, w) if rng.random() < 0.95 else rng.choice(stock) for w in part]
        docs.append((d, rng.choice([" ", "  ", "\n"]).join([text(4), *part, text(3)])))
    df = decontaminate.contaminated(frame(docs, DOCS), frame(items, ITEMS))
    expected = brute_force(docs, items)
    assert judged(df) == expected
    assert len({e[3] for e in expected.values()}) == 2


def test_items_without_literal_words_reflowed_and_parts_are_found(frame):
    dense = "Compute 17 * 23 + 4"
    units = "Convert 5 km 300 m 20 cm to 7 mm 8 inches"
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    city = "In June the shop in Paris sold 40 kg of apples to Anna, who then drove 12 km to Rome by car"
    docs = [
        (1, f"x {dense} y"), (2, f"well, {units} now"), (3, city.replace(" ", "\n")), (4, city.lower()),
        (5, " ".join(long.split()[10:38])), (6, " ".join(long.split()[10:21])),
    ]
    got = run(frame, docs, [(1, dense), (2, units), (3, city), (4, long)])
    assert got == {(1, 1): False, (2, 2): False, (3, 3): False, (4, 3): False, (5, 4): False}


def test_long_texts_and_ids_that_repeat(frame):
    body = " ".join(f"w{i}" for i in range(3_000))
    docs = [(1, f"{body} {QUESTION} {body}"), (2, "nothing"), (2, QUESTION), (3, "a " * 200_000)]
    assert run(frame, docs, [(7, QUESTION), (8, QUESTION)]) == {(1, 7): False, (1, 8): False, (2, 7): False, (2, 8): False}


QUESTION = "A train leaves the station at 9 and travels 120 km to reach Paris while another train travels 80 km in the rain."


def test_new_numbers_names_and_units_are_caught(frame):
    again = "So: a train leaves the station at 7 and travels 300 miles to reach Berlin while another train travels 45 miles in the rain, ok?"
    docs = [(1, f"Intro. {QUESTION} Outro."), (2, again), (3, "A train leaves the house and nobody travels at all today, not even in the rain.")]
    assert run(frame, docs, [(7, QUESTION)]) == {(1, 7): False, (2, 7): True}


def test_slots_must_agree(frame):
    item = "Take 5 apples and 5 pears then sell 5 apples and 5 pears then eat 5 apples and 5 pears at once."
    same = item.replace("5", "8")
    torn = "Take 1 apples and 2 pears then sell 3 apples and 4 pears then eat 5 apples and 6 pears at once."
    assert run(frame, [(1, same), (2, torn)], [(1, item)]) == {(1, 1): True}


def test_case_and_trailing_punctuation_do_not_matter(frame):
    item = "the quick brown fox jumps over the lazy dog near the river bank today"
    docs = [(1, item.title().replace(" ", "  \n") + "!"), (2, item.upper()), (3, "the quick brown fox sleeps")]
    assert {d for d, _ in run(frame, docs, [(1, item.replace("dog", "dog,"))])} == {1, 2}
    assert {d for d, _ in run(frame, [(4, "x y " + item + ". Z")], [(1, item)])} == {4}


def test_short_items_nulls_repeats_and_extra_columns(frame, spark):
    short = "alpha beta gamma delta epsilon zeta"
    docs = [(1, f"x {short} y"), (1, f"x {short} y"), (2, None), (3, ""), (None, short), (4, "w " * 30_000)]
    items = [(1, short), (1, short), (2, None), (3, ""), (None, short), (5, "too short")]
    assert run(frame, docs, items) == {(1, 1): False}
    clash = frame([(1, short, [1], "x")], "doc_id bigint, text string, template array<int>, hash string")
    more = frame([(1, short, 3)], "item_id bigint, text string, doc_id int")
    assert decontaminate.contaminated(clash, more).count() == 1
    none = spark.createDataFrame([], DOCS)
    assert decontaminate.contaminated(none, more).collect() == []
    assert decontaminate.contaminated(clash, spark.createDataFrame([], ITEMS)).collect() == []


def test_windows_of_placeholders_alone_match_nothing(frame):
    numbers = " ".join(str(i) for i in range(40))
    assert run(frame, [(1, " ".join(str(i + 50) for i in range(40)))], [(1, numbers)]) == {}


def test_templates_keep_one_token_per_word(frame):
    texts = ["a 1 b2c -3.5% x", "See Paris, and 5 km. Then Rome", "  ", "x|y | | z", "(a) ... !!", "é 12 kg, À Été"]
    rows = frame([(i, t) for i, t in enumerate(texts)], DOCS)
    sizes = rows.selectExpr("text").select(
        decontaminate.template(rows["text"]).alias("t"), decontaminate.words(rows["text"]).alias("w")
    )
    assert all(len(r["t"]) == len(r["w"]) for r in sizes.collect())
