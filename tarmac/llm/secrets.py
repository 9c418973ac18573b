"""Secret scan with a random forest that removes false positives, in DataFrame operations only.

Candidates are words of at least eight characters that are assigned to a secret's name, in the same word or
by the words before, carry a password in an address, or look random: 12 characters with a digit, or an issued key's form. Each
is described by its length, its character transitions (how probable its letters are after each other in the corpus, and
how often its classes of characters change), how much of it are words that many documents use, whether it is a path or an
address, and by the words next to it. A random forest learns from labelled findings which candidates are
secrets. Where none are given, candidates whose form settles the matter label themselves: issued key
formats, random values assigned to a secret's name and passwords in addresses on one side, other addresses, numbers and
words on the other.

Only words that can be candidates leave the array of a text's words, so what is shuffled grows with the findings. The
corpus is counted twice: pairs of letters, which are as many as the alphabet allows, and the documents of just those
words that are part of a candidate.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import held_out, stored

LEAST_LENGTH = 8
# Bound of the learning sample: at most this many labelled findings, half of each label, chosen by the hash of their id.
SAMPLE_FINDINGS = 20_000
TREES = 24
DEPTH = 6

# Names that secrets are assigned to.
SECRET_NAMES = (
    "password passwd pwd passphrase secret token apikey api_key api-key access_key access-key auth_token "
    "auth credential credentials private_key client_secret secret_key bearer"
).split()
# Such a name after nothing or after a prefix that ends in _ or -.
NAME_AT_END = f"(?:^|[_-])(?:{'|'.join(SECRET_NAMES)})$"
# Forms of keys that services issue.
ISSUED = (
    "^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^xox[abpr]-|^AIza[0-9A-Za-z_-]{35}$"
    "|^eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\."
)
ISSUED_STARTS = "AKIA|ASIA|gh[pousr]_|xox[abpr]-|AIza|eyJ"
# Fixed value: a user and a password in front of a host.
CREDENTIALS = "://[^/@:]+:[^/@]+@"
# A word is in the dictionary when so many documents use it.
LEAST_DOCUMENTS = 5
# Words of candidates are broadcast up to this many (some 40 bytes each).
BROADCAST_WORDS = 500_000
_LETTERS = "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "n_chars", "digit_share", "upper_share", "lower_share", "other_share", "distinct_share", "transition_share",
    "transition_logp", "longest_letters", "longest_digits", "dictionary_share", "slashes", "dots", "ats", "is_address", "credentials",
    "named_inline", "named_before", "assigned", "quoted", "number_before", "before_chars", "after_chars",
]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _share(value: Column, keep: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{keep}]", "")) / F.length(value)


def _longest(value: Column, pattern: str) -> Column:
    sizes = F.transform(F.regexp_extract_all(value, F.lit(f"({pattern})")), F.length)
    return F.coalesce(F.array_max(sizes), F.lit(0)).cast("double")


def _is_name(word: Column) -> Column:
    """A secret's name, also behind a prefix: DB_PASSWORD, x-api-key, dbPassword, spring.datasource.password."""
    parted = F.regexp_replace(word, "(?<=[a-z0-9])(?=[A-Z])|\\.(?=[A-Za-z])", "_")

    def ends(form: Column) -> Column:
        return F.regexp_replace(F.lower(form), "[^a-z_-]", "").rlike(NAME_AT_END)

    return ends(word) | ends(parted)


def _assigned_before(word: Column, before: Column, before2: Column) -> Column:
    """Whether the words before assign to a secret's name: ``name: x``, ``name = x``, ``name =x``, ``auth: Bearer x``."""
    signs = before.rlike("^[\"']?[:=]+>?$")
    here = before.rlike("[:=]$") & ~signs
    two = before2.rlike("[:=]$") & F.lower(before).rlike("^(?:bearer|basic|token)$")
    return (
        (here & _is_name(before))
        | (signs & _is_name(before2))
        | (word.rlike("^[:=]") & _is_name(before))
        | (two & _is_name(F.regexp_replace(before2, "(?i)authorization", "auth")))
    )


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, word_pos, name, value, before2, before, word, after) of every candidate word."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # A cheap test of the whole text first: a candidate has a digit, an issued key's start, or stands behind = or :.
    texts = texts.filter(F.col("text").rlike(f"[0-9]|[=:]|{ISSUED_STARTS}"))
    placed = texts.select("id", _words(F.col("text")).alias("words"))
    # Each word with the two before it, side by side: a look into the array per word would repeat the split.
    none = F.array(F.lit("").cast("string"))
    sides = F.arrays_zip(
        F.col("words").alias("word"),
        F.concat(none, "words").alias("before"),
        F.concat(none, none, "words").alias("before2"),
    )
    placed = placed.withColumn(
        "found",
        F.filter(
            F.transform(
                sides,
                lambda z, i: F.struct(z["word"].alias("word"), i.cast("int").alias("pos"), z["before"].alias("before"), z["before2"].alias("before2")),
            ),
            lambda s: (F.length(s["word"]) >= LEAST_LENGTH)
            & (
                s["word"].rlike(f"[0-9]|[=:].|{ISSUED_STARTS}")
                # A cheap test first: = or : at the end of one of the two words before.
                | s["before"].rlike("[:=]>?$")
                | s["before2"].rlike("[:=]$")
            ),
        ),
    )
    # Outer, as Spark would otherwise infer a filter that makes ``found`` a second time; no word, no candidate.
    at = placed.select("id", "words", F.explode_outer("found").alias("f"))

    def near(offset: int) -> Column:
        pos = F.col("f.pos") + offset
        inside = (pos >= 0) & (pos < F.size("words"))
        return F.coalesce(F.when(inside, F.get("words", pos)), F.lit(""))

    # name=value, name:"value" or the bare value; trailing punctuation is not part of it.
    dotted = f"(?:[A-Za-z0-9_-]++\\.)++(?=[A-Za-z0-9_-]*(?i:{'|'.join(SECRET_NAMES)})[\"']?[=:])"
    named = f"(?:[_$-]*+(?:{dotted})?([A-Za-z][A-Za-z0-9_-]*))?[\"']?[=:]+(?!/)"
    split = f"^[\"'(\\[{{<]*(?:{named})?[\"'(]*(.*?)[\"'.,;:!?)\\]}}>]*$"
    word = F.col("f.word")
    found = at.select(
        "id",
        F.col("f.pos").alias("word_pos"),
        word.alias("word"),
        F.regexp_extract(word, split, 1).alias("name"),
        F.regexp_extract(word, split, 2).alias("value"),
        near(-2).alias("before2"),
        near(-1).alias("before"),
        near(1).alias("after"),
    )
    random_form = F.col("value").rlike("[0-9]") & (F.length("value") >= 12)
    random_form = random_form | F.col("value").rlike(ISSUED) | F.col("value").rlike(CREDENTIALS)
    assigned = _is_name(F.col("name")) | _assigned_before(F.col("word"), F.col("before"), F.col("before2"))
    return found.filter((F.length("value") >= LEAST_LENGTH) & (random_form | assigned))


def _runs(value: Column) -> Column:
    """The runs of three letters or more, in lower case."""
    return F.regexp_extract_all(F.lower(value), F.lit("([a-z]{3,})"))


def letter_pairs(docs: DataFrame, text_col: str) -> dict[str, float]:
    """The log probability of each letter after another, over the words of all texts, each word once per text."""
    words = docs.select(F.explode(F.array_distinct(_runs(F.col(text_col).cast("string")))).alias("word"))
    places = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = words.select(F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
    counts = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}  # 676 at most
    first = {a: sum(counts.get(a + b, 0) for b in _LETTERS) for a in _LETTERS}
    return {a + b: math.log((counts.get(a + b, 0) + 1) / (first[a] + 26)) for a in _LETTERS for b in _LETTERS}


def known_words(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """(known): the words of candidates that at least ``LEAST_DOCUMENTS`` documents use."""
    asked = stored(found.select(F.explode(_runs(F.col("value"))).alias("known")).distinct(), "secrets-words")
    words = docs.select(F.explode(F.array_distinct(_runs(F.col(text_col).cast("string")))).alias("word"))
    small = F.broadcast(asked) if asked.count() <= BROADCAST_WORDS else asked
    used = words.join(small, F.col("word") == F.col("known"), "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    return stored(used.filter(F.col("n") >= LEAST_DOCUMENTS).select(F.col("word").alias("known")), "secrets-known")


def _with_known(found: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with ``known_chars``, the letters in words of the dictionary."""
    found = found.withColumn("_row", F.monotonically_increasing_id())
    found = stored(found, "secrets-rows")
    words = found.select("_row", F.explode(_runs(F.col("value"))).alias("word"))
    small = F.broadcast(known) if known.count() <= BROADCAST_WORDS else known
    chars = words.join(small, F.col("word") == F.col("known"), "left_semi").groupBy("_row").agg(
        F.sum(F.length("word")).alias("known_chars")
    )
    joined = found.join(chars, "_row", "left")
    return joined.withColumn("known_chars", F.coalesce("known_chars", F.lit(0))).drop("_row")


def described(found: DataFrame, pairs: dict[str, float]) -> DataFrame:
    """Candidates (with ``known_chars``) with the numeric columns of ``FEATURES``."""
    value = F.col("value")
    classes = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9"
    )
    collapsed = F.regexp_replace(classes, "(.)\\1+", "$1")
    table = F.create_map(*(x for pair, p in pairs.items() for x in (F.lit(pair), F.lit(p))))
    runs = F.transform(
        F.regexp_extract_all(F.lower(value), F.lit("([a-z]{2,})")),
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.element_at(table, F.substring(w, i, F.lit(2)))),
    )
    told = F.flatten(runs)
    mean = F.aggregate(told, F.lit(0.0), lambda a, p: a + p) / F.size(told)
    numeric = {
        "n_chars": F.length(value),
        "digit_share": _share(value, "0-9"),
        "upper_share": _share(value, "A-Z"),
        "lower_share": _share(value, "a-z"),
        "other_share": 1 - _share(value, "A-Za-z0-9"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "transition_share": (F.length(collapsed) - 1) / F.length(value),
        "longest_letters": _longest(value, "[A-Za-z]+"),
        "longest_digits": _longest(value, "[0-9]+"),
        "transition_logp": F.when(F.size(told) > 0, mean).otherwise(-math.log(26)),
        "dictionary_share": F.col("known_chars") / F.length(value),
        "slashes": F.length(F.regexp_replace(value, "[^/\\\\\\\\]", "")),
        "dots": F.length(F.regexp_replace(value, "[^.]", "")),
        "ats": F.length(F.regexp_replace(value, "[^@]", "")),
        "is_address": value.rlike("(?i)://|^www\\.|\\.(com|net|org|html?)$"),
        "credentials": value.rlike(CREDENTIALS),
        "named_inline": _is_name(F.col("name")),
        "named_before": _is_name(F.col("before")) | _is_name(F.col("before2")),
        "assigned": (F.col("name") != "") | F.col("before").rlike("[=:]>?$") | F.col("word").rlike("^[=:]"),
        "quoted": F.col("word").rlike("[\"']"),
        "number_before": F.col("before").rlike("^[(+]?[0-9]"),
        "before_chars": F.length("before"),
        "after_chars": F.length("after"),
    }
    return found.withColumns({name: column.cast("double") for name, column in numeric.items()})


def own_label() -> Column:
    """1 or 0 where a candidate's form settles it, else null."""
    value = F.col("value")
    issued = value.rlike(ISSUED)
    random = value.rlike("^[0-9a-f]{16,}$|^[0-9A-Za-z+/_-]{20,}=*$") & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    named = (F.col("named_inline") + F.col("named_before")) > 0
    credentials = value.rlike(CREDENTIALS)
    harmless = (
        (value.rlike("^[^@]+@[^@]+\\.[a-z]+$|^[0-9.:/,+() -]+$|://|^www\\.") & ~credentials)
        | value.rlike("^v?[0-9]+(\\.[0-9]+)+|^[0-9]{4}-[0-9]{2}-[0-9]{2}")
        | value.rlike("(?i)^(example|sample|dummy|changeme|your)|x{4,}|\\*{3,}")
    )
    return F.when(issued | ((credentials | (random & named)) & ~harmless), 1).when(harmless, 0)


def by_form() -> Column:
    """The score of a candidate where there is nothing to learn from: its own label, else whether it is assigned to a name."""
    named = (F.col("named_inline") + F.col("named_before")) > 0
    return F.coalesce(own_label(), F.when(named, 1).otherwise(0)).cast("double")


def train(found: DataFrame, sample: int = SAMPLE_FINDINGS, seed: int = 7):
    """A forest from (id, word_pos, label, features) rows, or None unless both labels occur.

    Of each label at most half of ``sample`` is gathered, smallest hashes first, so that a rare label is not crowded
    out by the other, and in a fixed order, so that the forest does not depend on partitions.
    """
    counts = {r[0]: r[1] for r in found.groupBy("label").count().collect()}
    if not {0, 1} <= counts.keys():
        return None
    each = max(1, sample // 2)
    mixed = F.xxhash64(F.col("id").cast("string"), "word_pos")
    # Twice the share that is needed goes into the ranking, so no task ranks a whole label.
    near = F.lit(False)
    for label in (0, 1):
        low = int((2 * min(1, (2 * each + 50) / counts[label]) - 1) * 2**63)
        near = near | ((F.col("label") == label) & (mixed <= min(low, 2**63 - 1)))
    order = Window.partitionBy("label").orderBy(mixed, "id", "word_pos", *FEATURES)
    rows = found.filter(near).select("id", "word_pos", "label", *FEATURES).withColumn("_rank", F.row_number().over(order))
    rows = stored(rows.filter(F.col("_rank") <= each).drop("_rank"), "secrets-sample")
    if rows.select("label").distinct().count() < 2:
        return None
    rows = rows.coalesce(1).sortWithinPartitions("id", "word_pos", *FEATURES)
    forest = RandomForestClassifier(
        labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt"
    )
    return forest.fit(_assembled(rows).select("label", "features"))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: DataFrame | None = None,
    sample: int = SAMPLE_FINDINGS,
) -> DataFrame:
    """(id, word_pos, name, masked, n_chars, score, is_secret) for every candidate.

    ``word_pos`` counts words between ASCII white space from 0: it tells where the value is, of which nothing else is given away
    but its length and, of 20 characters or more, the first four (``masked``). The score is
    the forest's share for a secret, ``is_secret`` from 0.5 on. ``labelled`` holds (id, word_pos, label) of
    known findings in these documents; without it, rows not held out (crc32 of the id modulo 5 is not 0)
    label themselves by form. If not both labels occur, every candidate is scored by its own form (``by_form``).

    Null and empty texts have no candidates. Repeated rows report their candidates each, rows without an id too. Texts of any
    length are scanned whole. An empty table gives none. Other columns are ignored.
    """
    found = stored(candidates(docs, id_col, text_col), "secrets-found")
    found = _with_known(found, known_words(docs, found, text_col))
    found = stored(described(found, letter_pairs(docs, text_col)), "secrets-candidates")
    if labelled is None:
        known = found.filter(~held_out("id", 5, 0)).withColumn("label", own_label())
        known = known.filter("label is not null")
    else:
        facts = labelled.select(
            F.col(id_col).alias("known_id"), F.col("word_pos").alias("known_pos"), F.col("label").cast("int")
        ).filter("label in (0, 1)")
        same = (F.col("id") == F.col("known_id")) & (F.col("word_pos") == F.col("known_pos"))
        known = found.join(facts, same).drop("known_id", "known_pos")
    model = train(known, sample)
    if model is None:
        scored = found.withColumn("score", by_form())
    else:
        scored = model.transform(_assembled(found)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    return scored.select(
        F.col("id").alias(id_col),
        "word_pos",
        "name",
        F.concat(F.when(F.col("n_chars") >= 20, F.substring("value", 1, 4)).otherwise(F.lit("")), F.lit("...")).alias("masked"),
        F.col("n_chars").cast("int").alias("n_chars"),
        F.round("score", 6).alias("score"),
        (F.round("score", 6) >= 0.5).alias("is_secret"),
    )
