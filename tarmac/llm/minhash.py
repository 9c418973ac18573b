"""Near-duplicate groups by min-max hashing.

Of every permutation both the smallest and the largest hash of a document's shingles are kept, so 96
evaluations give a signature of 192 values. Either value agrees between two documents with
probability equal to their similarity, so estimates and bands stay unbiased, and taking both ends
of one permutation lowers the variance. Bands find candidates, and are laid out for the threshold: 32 bands of
six values (three permutations) miss a pair at similarity 0.85 with probability (1 - 0.85^6)^32, 38 bands of
five values (of five permutations) a pair at 0.80 with (1 - 0.8^5)^38, both below 1e-6.

1. Documents with one shingle set form a class; its smallest id stands for it from there on.
2. In every bucket each member is compared with the smallest member only. Links are confirmed on full
   sets, and linked classes merge into components. Bands whose smallest member is the same document make one bucket, in
   which each of its documents is once: near copies meet in most of their bands, and are not judged once for each.
3. Buckets whose members are all in one component are done. In others of more than ``FEW`` members pivot rounds (``PIVOTS``) follow: a bucket offers
   16 members of different components, and the members of other components are compared with these only; links are
   confirmed and merged before the next round. So a group of near copies closes after as many comparisons as it has
   members, times the pivots, and no member is copied more often than there are pivots.
4. What is open then is judged in full. Members outside a bucket's largest component are compared with all of the
   bucket where they are few (``FEW``). Where they are many, candidates come from an exact prefix filter: two sets over the
   threshold share one of the rarest shingles of each, as many as leave fewer than the threshold asks for.
   Per shingle again only members outside its largest component are compared with all.

Only pairs of different components that the sizes, the parities of 1024 parts of the shingle space (each odd difference
is at least one shingle that only one set has) and one bit per signature value leave plausible are emitted and confirmed.
So every pair of different components that meets in a bucket is judged, without pairs inside
a group that is linked already.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import keep_ids, ship_package, stored
from tarmac.llm.components import components
from tarmac.llm.hashing import mix64, whole, windows, word_hashes

SHINGLE_WORDS = 5
PERMUTATIONS = 96
# Values in a band at most; lower thresholds take fewer, so that a pair is missed with a probability below MISS.
PER_BAND = 6
MISS = 1e-6
# Pivots of a bucket in each round, and members outside its largest component that are compared with all of it.
PIVOTS = (16,)
FEW = 64
# Slots, as a power of two, in which shingles are counted to tell rare ones from frequent ones, and those of one packed row.
SLOT_BITS, PACKED_BITS = 20, 16
# Counts up to this are told apart; above it, eight levels are an octave.
PLAIN_COUNTS = 128
# A linked pair agrees in 192 * (1 + similarity) / 2 bits on average; this many standard
# deviations fewer still count as plausible.
BIT_DEVIATIONS = 6.5
SKETCH_WORDS = 2 * PERMUTATIONS // 64
PARITY_WORDS = 16
_STRIDE = 1024

_SEEDS = mix64(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64))
_XOR, _TIMES = _SEEDS[:PERMUTATIONS, None], _SEEDS[PERMUTATIONS:, None] | np.uint64(1)
_BAND_SEEDS = mix64(np.arange(1000, 1000 + 2 * PERMUTATIONS, dtype=np.uint64))
_POWERS = (_SEEDS[: PER_BAND] | np.uint64(1))[None, :]


def band_size(percent: int) -> int:
    """Values in a band for a threshold: as many as keep the chance to miss a pair below ``MISS``."""
    for size in range(PER_BAND, 1, -1):
        if (1 - (percent / 100) ** size) ** band_count(size) < MISS:
            return size
    return 1


def band_count(size: int) -> int:
    return 2 * (PERMUTATIONS // size) if size % 2 else 2 * PERMUTATIONS // size


def shingle_set(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z lower-cased; a shorter text is one shingle."""
    hashes = word_hashes(text.lower())[0]  # bytes.lower changes A-Z only
    if not len(hashes):
        return hashes
    return np.unique(whole(hashes) if len(hashes) < words else windows(hashes, words))


def min_max(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the shingles under every permutation, side by side."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), _STRIDE):
        values = (shingles[None, at : at + _STRIDE] ^ _XOR) * _TIMES
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high], axis=1).reshape(-1)


def band_keys(signature: np.ndarray, size: int = PER_BAND) -> np.ndarray:
    """One key per band. Even bands hold both ends of their permutations, odd ones one end of each."""
    values, count = mix64(signature), band_count(size)
    if size % 2:
        ends = values.reshape(PERMUTATIONS, 2).T
        rows = ends[:, : PERMUTATIONS // size * size].reshape(count, size)
    else:
        rows = values[: count * size].reshape(count, size)
    return mix64((rows * _POWERS[:, :size]).sum(axis=1, dtype=np.uint64) ^ _BAND_SEEDS[:count])


def sketch_bits(signature: np.ndarray) -> np.ndarray:
    """One bit per signature value, in three 64-bit words."""
    return np.packbits((mix64(signature) >> np.uint64(63)).astype(np.uint8)).view("<i8")


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Whether each of 1024 parts of the shingle space holds an odd number of the set's shingles."""
    part = (shingles >> np.uint64(54)).astype(np.int64)
    return np.packbits((np.bincount(part, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)).view("<i8")


SIGNATURE_SCHEMA = (
    "id bigint, text_hash bigint, n_shingles bigint, set_digest binary, bands array<bigint>, bits array<bigint>"
)


def _signatures(words: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands, bits = [], [], [], []
            for text in batch["text"]:
                shingles = shingle_set(text.as_py() or b"", words)
                sizes.append(len(shingles))
                if len(shingles):
                    signature = min_max(shingles)
                    digests.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(signature, size).view(np.int64))
                    bits.append(np.concatenate([sketch_bits(signature), parity_bits(shingles)]))
                else:
                    digests.append(None)
                    bands.append(None)
                    bits.append(None)
            yield pa.record_batch(
                [
                    batch["id"],
                    batch["text_hash"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                names=["id", "text_hash", "n_shingles", "set_digest", "bands", "bits"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few texts at a time: a set takes several times its text's bytes.
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(t.as_py() or b"", words).view(np.int64) for t in part["text"]]
                yield pa.record_batch(
                    [part["id"], pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"]
                )

    return run


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
    )


def _plausible(percent: int, a: str, b: str) -> Column:
    """What pairs over the threshold satisfy: close sizes, few odd parts, and most signature bits alike."""
    similarity = percent / 100
    agree = (1 + similarity) / 2
    total = 2 * PERMUTATIONS
    least = total * agree - BIT_DEVIATIONS * (total * agree * (1 - agree)) ** 0.5
    n_a, n_b = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")

    def differ(words: range) -> Column:
        pairs = [(F.col(f"{a}.bits")[i], F.col(f"{b}.bits")[i]) for i in words]
        return sum(F.bit_count(x.bitwiseXOR(y)) for x, y in pairs)

    close = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    # Sets of that similarity differ in at most this many shingles, hence parities.
    odd = differ(range(SKETCH_WORDS, SKETCH_WORDS + PARITY_WORDS))
    few = (100 + percent) * odd <= (100 - percent) * (n_a + n_b)
    return close & few & (differ(range(SKETCH_WORDS)) <= int(total - least))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("a_set"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("b_set"))
    joined = pairs.join(first, "a").join(second, "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - shared
    return joined.filter(100 * shared >= percent * union).select("a", "b")


def _pivot_pairs(members: DataFrame, pivots: int, percent: int) -> DataFrame:
    """Plausible pairs of each bucket's pivots, one member each of that many components, with members of others."""
    one_each = members.groupBy("key", "component").agg(
        F.min(F.struct(F.xxhash64("id", F.lit(pivots)).alias("mixed"), "id", "n_shingles", "bits")).alias("pivot")
    )
    place = F.row_number().over(Window.partitionBy("key").orderBy("pivot.mixed", "pivot.id"))
    chosen = one_each.withColumn("place", place).filter(F.col("place") <= pivots)
    chosen = chosen.select("key", "component", "pivot.id", "pivot.n_shingles", "pivot.bits")
    pair = (
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.component") != F.col("r.component"))
        & _plausible(percent, "l", "r")
    )
    return _ordered(members.alias("l").join(chosen.alias("r"), pair))


def _ordered(joined: DataFrame) -> DataFrame:
    return joined.select(F.greatest("l.id", "r.id").alias("a"), F.least("l.id", "r.id").alias("b")).distinct()


def _with_minors(members: DataFrame) -> DataFrame:
    """The members with ``minor``: not in the largest component of their key, ``minors``: how many are not, ``all``."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all")
    )
    largest = largest.select(
        F.col("key").alias("bucket"), F.col("top.component").alias("largest"), (F.col("all") - F.col("top.size")).alias("minors"), "all"
    )
    return members.join(largest, F.col("key") == F.col("bucket")).select(
        *members.columns, (F.col("component") != F.col("largest")).alias("minor"), "minors", "all"
    )


def _sketched(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members with size and bits. A document is in no more buckets than there are bands, so its places are
    gathered and looked up together: the join has one row per document."""
    places = F.collect_list(F.struct(*(c for c in members.columns if c != "id"))).alias("places")
    joined = members.groupBy("id").agg(places).join(sketches, "id")
    return joined.select("id", "n_shingles", "bits", F.inline("places"))


def _minor_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of different components within each key: those outside the largest one with all."""
    pair = (
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.component") != F.col("r.component"))
        & (~F.col("r.minor") | (F.col("l.id") < F.col("r.id")))
        & _plausible(percent, "l", "r")
    )
    return _ordered(members.filter("minor").alias("l").join(members.alias("r"), pair))


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for batch in batches:
        np.add.at(counts, _slots(batch["shingles"].flatten().to_numpy()), 1)
    held = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(held), pa.array(counts[held])], names=["slot", "n"])


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts in one byte each, in their order: more is never less."""
    above = PLAIN_COUNTS + np.floor(8 * np.log2(np.maximum(counts, PLAIN_COUNTS) / PLAIN_COUNTS))
    return np.minimum(np.where(counts <= PLAIN_COUNTS, counts, above), 255).astype(np.uint8)


def _packed(table: pa.Table) -> pa.Table:
    levels = np.zeros(1 << PACKED_BITS, dtype=np.uint8)
    levels[table["slot"].to_numpy() & (len(levels) - 1)] = _levels(table["n"].to_numpy())
    return pa.table({"part": table["part"].slice(0, 1), "levels": pa.array([levels.tobytes()], pa.binary())})


def _slot_levels(sets: DataFrame) -> DataFrame:
    """How often each slot was met, as levels packed into a few rows, so that the driver holds a byte a slot."""
    met = sets.mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    met = met.withColumn("part", F.shiftright("slot", PACKED_BITS))
    return met.groupBy("part").applyInArrow(_packed, "part bigint, levels binary")


def _rarest(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            prefixes = []
            for shingles in batch["shingles"]:
                shingles = shingles.values.to_numpy()
                often = counts[_slots(shingles)]
                length = len(shingles) - (percent * len(shingles) + 99) // 100 + 1
                first = np.lexsort((shingles, often))[:length]
                # Shingles that are alone in their slot take a place in the prefix, but meet nobody.
                prefixes.append(shingles[first[often[first] > 1]])
            yield pa.record_batch([batch["id"], pa.array(prefixes, pa.list_(pa.int64()))], names=["id", "prefix"])

    return run


def _prefixes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members by their rarest shingles: as many as two sets over the threshold cannot both do without.

    Any one order of all shingles will do. They are ordered by how often their slot, of 2^``SLOT_BITS``, was met, which is
    counted and sent to the tasks as a byte a slot, so a set is cut to its prefix where it lies.
    """
    levels = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    for row in _slot_levels(sets).collect():  # 16 rows
        at = row["part"] << PACKED_BITS
        levels[at : at + (1 << PACKED_BITS)] = np.frombuffer(row["levels"], dtype=np.uint8)
    shared = sets.sparkSession.sparkContext.broadcast(levels)
    cut = sets.mapInArrow(_rarest(shared, percent), "id bigint, prefix array<bigint>")
    return cut.join(members, "id").select(*members.columns, F.explode("prefix").alias("key"))


def _remaining_pairs(placed: DataFrame, sets: DataFrame, percent: int, few: int) -> DataFrame:
    """All plausible pairs of different components that meet in an open bucket."""
    near = _minor_pairs(placed.filter(F.col("minors") <= few), percent)
    crowded = stored(
        placed.filter(F.col("minors") > few).select("id", "component", "n_shingles", "bits").distinct(), "minhash-crowded"
    )
    if crowded.isEmpty():
        return near
    own = keep_ids(sets, stored(crowded.select("id"), "minhash-crowded-ids"), "id")
    prefixes = stored(_with_minors(_prefixes(crowded, own, percent)).filter("minors > 0"), "minhash-prefixes")
    return near.union(_minor_pairs(prefixes, percent)).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    shingle_words: int = SHINGLE_WORDS,
    pivots: Sequence[int] = PIVOTS,
    few: int = FEW,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, class_id, text_hash.

    Documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets (words between
    ASCII white space, A-Z lower-cased; fewer words than a shingle are one shingle). The component is
    the smallest id reachable, and the document with that id is kept; ``class_id`` is the smallest id with the
    same set; ``text_hash`` (xxhash64 of the text) tells rows apart that share an id. The bands are laid out for ``percent``; ``pivots`` and ``few`` change the work, not the result.

    A document without words (null, empty, white space) has an empty set and is its own component.
    Repeated rows are returned each. Rows without an id are linked like others but stand for nothing: their
    component is that of the rows with an id that have their set, or null. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    columns = _columns(docs, id_col, text_col)
    signed = stored(columns.mapInArrow(_signatures(shingle_words, band_size(percent)), SIGNATURE_SCHEMA), "minhash")
    classes = (
        signed.filter("set_digest is not null and id is not null")
        .groupBy("set_digest")
        .agg(F.min("id").alias("class_id"))
    )
    classes = stored(classes, "minhash-classes")
    # The signature of a class is that of its smallest document.
    leads = classes.select(F.col("class_id"), F.col("set_digest").alias("lead_digest"))
    own = (F.col("id") == F.col("class_id")) & (F.col("set_digest") == F.col("lead_digest"))
    leads = signed.join(leads, own, "left_semi").select("id", "n_shingles", "bands", "bits")
    leads = stored(leads, "minhash-leads")

    members = leads.select("id", F.explode("bands").alias("key"))
    buckets = (
        members.groupBy("key")
        .agg(F.min("id").alias("first"), F.count("*").alias("size"))
        .filter("size > 1")
        .select(F.col("key").alias("bucket"), "first")
    )
    # Bands with the same smallest member are one bucket from here on, so a document that shares many of them is in it once.
    shared = stored(
        members.join(buckets, F.col("key") == F.col("bucket")).select(F.col("first").alias("key"), "id").distinct(),
        "minhash-buckets",
    )
    to_first = shared.filter("id > key").select(F.col("id").alias("a"), F.col("key").alias("b"))
    sketches = leads.select("id", "n_shingles", "bits")
    first_pairs = stored(_judged(to_first, sketches, percent), "minhash-first-pairs")
    # Only documents that share a bucket can be in any pair.
    sets = stored(
        keep_ids(columns, stored(shared.select("id").distinct(), "minhash-ids"), "id").mapInArrow(
            _sets(shingle_words), "id bigint, shingles array<bigint>"
        ),
        "minhash-sets",
    )
    links = stored(_confirmed(first_pairs, sets, percent), "minhash-links")
    merged = stored(components(links), "minhash-merged")

    placed = None
    for number in (*pivots, None):
        if placed is None:
            placed = stored(_sketched(_with_minors(_open_members(shared, merged)), sketches), "minhash-open")
        if number is None:
            more = _remaining_pairs(placed, sets, percent, few)
        elif (large := placed.filter(F.col("all") > few)).isEmpty():
            continue
        else:
            more = _pivot_pairs(large, number, percent)
        more_links = stored(_confirmed(stored(more, "minhash-pairs"), sets, percent), "minhash-links")
        if not more_links.isEmpty():
            # The stars that are known already, and what links them.
            stars = merged.select(F.col("id").alias("a"), F.col("component").alias("b"))
            merged, placed = stored(components(stars.unionByName(more_links)), "minhash-merged"), None

    joined = classes.join(merged.withColumnRenamed("id", "node"), F.col("class_id") == F.col("node"), "left")
    groups = joined.select(
        F.col("set_digest").alias("group_digest"),
        "class_id",
        F.coalesce("component", "class_id").alias("group_component"),
    )
    found = signed.select("id", "text_hash", "n_shingles", "set_digest").join(
        groups, F.col("set_digest") == F.col("group_digest"), "left"
    )
    component = F.when(F.col("set_digest").isNull(), F.col("id")).otherwise(F.col("group_component"))
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        F.when(F.col("set_digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        "text_hash",
    )


def _judged(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and bits leave plausible."""
    a = sketches.select(F.col("id").alias("a"), F.struct("n_shingles", "bits").alias("x"))
    b = sketches.select(F.col("id").alias("b"), F.struct("n_shingles", "bits").alias("y"))
    joined = pairs.join(a, "a").join(b, "b")
    return joined.filter(_plausible(percent, "x", "y")).select("a", "b")


def _open_members(shared: DataFrame, merged: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component."""
    placed = shared.join(merged.withColumnRenamed("id", "node"), F.col("id") == F.col("node"), "left")
    placed = placed.select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select(F.col("key").alias("bucket"))
    )
    return placed.join(mixed, F.col("key") == F.col("bucket"), "left_semi")
