"""Benchmark decontamination by question templates, in DataFrame operations only.

A text becomes a template of one token per word: numbers, names and units after a number are replaced by typed
placeholders, other words lose their case and trailing punctuation. Windows of template words of the
documents are hash-joined with those of the benchmark. Matches are then compared word by word, and their
slots must agree: within one alignment of a document with an item, one value of the item stands for one
value of the document throughout. A question asked again with other numbers passes; words that
merely fall on the same pattern do not.

Beside its template a text has its plain words, with case and trailing punctuation removed and nothing replaced. Windows of
plain words are joined alike and need no slots: so an item is found whatever its windows are made of, and however its
line breaks, spaces and capitals are changed. Windows of templates need some literal words, since placeholders alone say little.

A document is reported with an item when windows that hold cover enough of the item's words, or a run of its plain words
is long enough by itself. The windows of the documents meet the benchmark in the task that reads them: only hits are shuffled. The
benchmark is broadcast when its counted windows are few enough, else both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import keep_ids, stored

WINDOW_WORDS = 8
LEAST_ITEM_WORDS = 5
LEAST_LITERALS = 4
PERCENT = 50
# A run of so many plain words of an item is a leak, whatever its share of the item.
RUN_WORDS = 13
# A benchmark window is three numbers; this many take about 32 MB as a hash table.
BROADCAST_WINDOWS = 500_000

NUMBER, NAME, UNIT = "", "", ""
SLOTS = [NUMBER, NAME, UNIT]
# Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons "
    "oz lb lbs pound pounds ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years percent cent cents dollar dollars euro euros "
    "meter meters metre metres kilometer kilometers kilometre kilometres degree degrees"
).split()


SPACE = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Words between ASCII white space; an empty array for null and for texts without words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def _spaced(text: Column) -> Column:
    """One space between words."""
    return F.when(text.rlike("[\\x09-\\x0D]|\\x20\\x20"), F.regexp_replace(text, SPACE, " ")).otherwise(text)


def _bare(text: Column) -> Column:
    """Words in lower case, without punctuation after their last letter or digit."""
    return words(F.lower(F.regexp_replace(text, "(?<=[\\p{L}\\p{N}])\\p{Punct}++(?![^\\x20\\x09-\\x0D])", "")))


def plain(text: Column) -> Column:
    """The plain words of a text, as many as its template has tokens."""
    return _bare(_spaced(text))


def template(text: Column) -> Column:
    """One template token per word of the text, in order."""
    text = _spaced(text)
    digits = F.when(
        text.rlike("[0-9]"),
        F.regexp_replace(text, "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+", NUMBER),
    ).otherwise(text)
    # A capital in mid-sentence: the word before ends in a letter, comma or placeholder.
    names = F.regexp_replace(
        digits, f"(?<=[\\p{{Ll}},;{NUMBER}] )\\p{{Lu}}[^\\x20\\x09-\\x0D]*+", NAME
    )
    unit = "|".join(UNITS)
    units = F.when(
        names.contains(NUMBER),
        F.regexp_replace(names, f"(?<={NUMBER} )(?:{unit})\\p{{Punct}}*(?![^\\x20\\x09-\\x0D])", UNIT),
    ).otherwise(names)
    return _bare(units)


def _is_slot(token: Column) -> Column:
    return token.isin(*SLOTS)


def _windows(rows: DataFrame, tokens: str, sizes: list[int], *carry: str) -> DataFrame:
    """(carry, at, size, hash) of all windows of each size over an array of words.

    The words' hashes are laid side by side, each shifted by one place more, so a row that is exploded holds
    one window and not the text.
    """
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    rows = rows.select(*carry, hashes.alias("_hashes")).filter(F.size("_hashes") > 0)
    longest = max(sizes)
    shifted = [
        F.slice("_hashes", k + 1, F.greatest(F.size("_hashes") - k, F.lit(0))).alias(f"w{k}") if k else F.col("_hashes").alias("w0")
        for k in range(longest)
    ]
    placed = rows.select(*carry, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w"))
    parts = [F.col("w")[f"w{k}"] for k in range(longest)]
    if len(sizes) == 1:
        whole = placed.filter(parts[-1].isNotNull())
        return whole.select(*carry, "at", F.lit(longest).alias("size"), F.xxhash64(*parts).alias("hash"))
    several = F.array(
        *(F.struct(F.lit(n).alias("size"), F.when(parts[n - 1].isNotNull(), F.xxhash64(*parts[:n])).alias("hash")) for n in sizes)
    )
    every = placed.select(*carry, "at", F.inline(several))
    return every.filter("hash is not null")


def _item_windows(items: DataFrame, sizes: list[int], full: int) -> DataFrame:
    """Windows of the items at the size at which each is judged: of plain words all, of templates those that say enough."""
    judged = F.least("n_words", F.lit(full))
    kinds = items.select("item", judged.alias("judged"), "item_template", F.explode(F.array(F.lit(False), F.lit(True))).alias("is_plain"), "item_plain")
    tokens = kinds.select("item", "judged", "is_plain", "item_template", F.when(F.col("is_plain"), F.col("item_plain")).otherwise(F.col("item_template")).alias("tokens"))
    found = _windows(tokens, "tokens", sizes, "item", "judged", "is_plain").filter("size = judged")
    literals = F.size(F.filter(F.slice("t", F.col("at") + 1, F.col("size")), lambda t: ~_is_slot(t)))
    # A window without slots is the same in both forms, and is matched as plain words.
    says = (literals >= F.least(F.lit(LEAST_LITERALS), F.col("size"))) & (literals < F.col("size"))
    own = items.select(F.col("item").alias("i"), F.col("item_template").alias("t"))
    told = found.filter("not is_plain").join(own, F.col("item") == F.col("i")).filter(says).select(*found.columns)
    return found.filter("is_plain").unionByName(told).select(
        "item", F.col("at").alias("pos"), F.col("size").alias("item_size"), "is_plain", F.col("hash").alias("item_hash")
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    percent: int = PERCENT,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """(id, item, item_words, covered_words, longest_run, reparameterised) for each document that has an item's text.

    A pair is returned when windows whose words and slots agree cover at least ``percent`` of the
    item's words, or ``run_words`` plain words of the item follow each other in the document (``longest_run`` tells how many do);
    ``reparameterised`` tells that some slot has another value than in the item. Items
    shorter than a window are matched whole; items of fewer than five words are too short to tell and
    ignored. Two items on one passage are both reported. Rows of either table without an id, null and empty texts give nothing;
    repeated rows are reported once; the ids are taken to name one text each. Texts of any length are judged whole. An empty
    table of either kind gives none. Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter("id is not null and text is not null")
    items = stored(
        benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
        .filter("item is not null and text is not null")
        .select(
            "item", template(F.col("text")).alias("item_template"), plain(F.col("text")).alias("item_plain"),
            words(F.col("text")).alias("item_raw"),
        )
        .withColumn("n_words", F.size("item_template"))
        .filter(F.col("n_words") >= LEAST_ITEM_WORDS)
        .dropDuplicates(["item"]),
        "benchmark-items",
    )
    sizes = items.select(F.least("n_words", F.lit(window_words)).alias("size")).distinct()
    sizes = sorted(r[0] for r in sizes.collect()) or [window_words]  # at most one per window length

    item_windows = stored(_item_windows(items, sizes, window_words), "benchmark-windows")
    if item_windows.count() <= BROADCAST_WINDOWS:
        item_windows = F.broadcast(item_windows)
    # Texts without slots have one form.
    forms = texts.select("id", template(F.col("text")).alias("t"), plain(F.col("text")).alias("p"))
    forms = forms.select("id", F.explode(F.array_distinct(F.array("t", "p"))).alias("tokens"))
    met_windows = (F.col("hash") == F.col("item_hash")) & (F.col("size") == F.col("item_size"))
    hits = _windows(forms, "tokens", sizes, "id").join(item_windows, met_windows)
    hits = stored(hits.select("id", "at", "item", "pos", "size", "is_plain").distinct(), "benchmark-hits")

    met = stored(hits.select("id").distinct(), "benchmark-docs")
    full = keep_ids(texts, met, "id").select(
        "id", template(F.col("text")).alias("template"), plain(F.col("text")).alias("plain"), words(F.col("text")).alias("raw")
    )
    # Only the words of the windows go on to the items.
    given = hits.join(full, "id").select(
        "id", "item", "at", "pos", "size", "is_plain",
        F.slice(F.when(F.col("is_plain"), F.col("plain")).otherwise(F.col("template")), F.col("at") + 1, F.col("size")).alias("given_tokens"),
        F.slice("raw", F.col("at") + 1, F.col("size")).alias("given"),
    )
    asked = F.slice(
        F.when(F.col("is_plain"), F.col("item_plain")).otherwise(F.col("item_template")), F.col("pos") + 1, F.col("size")
    )
    exact = given.join(items, "item").filter(F.col("given_tokens") == asked)
    values = F.arrays_zip(
        F.slice("item_template", F.col("pos") + 1, F.col("size")).alias("token"),
        F.slice("item_raw", F.col("pos") + 1, F.col("size")).alias("asked"),
        F.col("given").alias("given"),
    )
    no_slots = F.filter(values, lambda v: F.lit(False))
    aligned = stored(
        exact.select(
            "id", "item", "n_words", "pos", "size", "is_plain", (F.col("at") - F.col("pos")).alias("shift"),
            F.when(F.col("is_plain"), no_slots).otherwise(F.filter(values, lambda v: _is_slot(v["token"]))).alias("slots"),
        ),
        "benchmark-aligned",
    )
    place = ["id", "item", "shift"]
    slots = aligned.select(*place, "pos", F.explode("slots").alias("slot")).select(
        *place, "pos", "slot.asked", "slot.given"
    )
    torn = (
        slots.groupBy(*place, "asked")
        .agg(F.min("given").alias("low"), F.max("given").alias("high"))
        .filter("low != high")
        .select(*place, "asked")
    )
    bad = slots.join(torn, [*place, "asked"], "left_semi").select(*place, "pos").distinct()
    bad = bad.withColumn("is_plain", F.lit(False))
    changed = F.exists("slots", lambda v: v["asked"] != v["given"])
    covered = (
        aligned.join(bad, [*place, "pos", "is_plain"], "left_anti")
        .select(
            "id", "item", "n_words", F.when(~F.col("is_plain"), changed).otherwise(F.lit(False)).alias("changed"),
            F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("size") - 1)).alias("word"),
        )
        .groupBy("id", "item", "n_words", "word")
        .agg(F.min("changed").alias("changed"))
        .groupBy("id", "item", "n_words")
        .agg(F.count("*").cast("int").alias("covered_words"), F.max("changed").alias("reparameterised"))
    )
    runs = _longest_runs(aligned.filter("is_plain"), place)
    judged = covered.join(runs, ["id", "item"], "left")
    run = F.coalesce("longest_run", F.lit(0))
    enough = (100 * F.col("covered_words") >= percent * F.col("n_words")) | (run >= run_words)
    return judged.filter(enough).select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        F.col("n_words").alias("item_words"),
        "covered_words",
        run.alias("longest_run"),
        "reparameterised",
    )


def _longest_runs(aligned: DataFrame, place: list[str]) -> DataFrame:
    """Per document and item, the most plain words of the item in a row: windows that follow each other in one alignment."""
    windows = aligned.select(*place, "pos", "size").distinct()
    order = F.row_number().over(Window.partitionBy(*place).orderBy("pos"))
    run = windows.withColumn("run", F.col("pos") - order).groupBy(*place, "run")
    lengths = run.agg((F.max("pos") - F.min("pos") + F.max("size")).alias("length"))
    return lengths.groupBy("id", "item").agg(F.max("length").alias("longest_run"))
