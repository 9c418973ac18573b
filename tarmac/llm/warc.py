"""Web archives: writing, reading back, and merging capture indexes.

Pages become WARC 1.1 records. Of equal payloads the capture with the smallest id is a response with the
payload, the others revisit it. Spark's text writer puts the records into archive files (each record
ends with two line ends), so any storage that Spark writes to will do, and the files are read
back whole, one bounded file at a time, and parsed by their declared lengths.

Every archive yields an index run sorted by URL key, time and id. Ranges of the keys are merged
independently: in each, a loser tree takes the smallest head of its k runs, replaying one path of the tree per
capture. The ranges in order are the captured histories of all URLs, globally sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import shards, ship_package, stored
from tarmac.session import scratch_path

LEAST_REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
RANGE_ROWS = 100_000
BROADCAST_REVISITS = 500_000
LINE = "\r\n"
# Captures without a time of their own are dated from here, a second per id.
FIRST_SECOND = 1_704_067_200

CAPTURE_SCHEMA = (
    "run string, url_key string, captured string, page_id bigint, url string, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint, offset bigint, length bigint"
)


# --- writing ------------------------------------------------------------------------


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def records(
    pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int
) -> DataFrame:
    """One WARC record per page, as text without the closing line ends."""
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumns(
        {"size": F.octet_length("html"), "digest": F.sha2(F.col("html").cast("binary"), 256)}
    )
    facts = stored(rows.select("page", "size", "digest").filter("page is not null"), "warc-payloads")
    large = facts.filter(F.col("size") >= least_bytes)
    firsts = large.groupBy("digest").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    firsts = firsts.filter("first < last").select(F.col("digest").alias("shared"), "first")
    revisits = stored(
        large.join(firsts, (F.col("digest") == F.col("shared")) & (F.col("page") > F.col("first")))
        .select(F.col("page").alias("again"), F.col("digest").alias("again_digest"), "first")
        .distinct(),
        "warc-revisits",
    )
    if revisits.count() <= BROADCAST_REVISITS:
        revisits = F.broadcast(revisits)
    same = (F.col("page") == F.col("again")) & (F.col("digest") == F.col("again_digest"))
    rows = rows.join(revisits, same, "left")

    is_response = F.col("first").isNull()
    seconds = F.lit(FIRST_SECOND) + F.coalesce(F.pmod("page", F.lit(10**9)), F.lit(0))
    captured = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(LINE + LINE),
    )
    block = F.concat(http, F.when(is_response, F.col("html")).otherwise(F.lit("")))
    headers = [
        F.lit("WARC/1.1"),
        F.when(is_response, "WARC-Type: response").otherwise("WARC-Type: revisit"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page"))),
        F.concat(F.lit("WARC-Date: "), captured),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(~is_response, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first")))),
        F.when(
            ~is_response,
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    # concat_ws leaves out headers that do not apply.
    return rows.select(F.concat(F.concat_ws(LINE, *headers), F.lit(LINE + LINE), block).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write the pages to archive files of about ``archive_bytes`` on average under ``path``."""
    count, size = pages.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(html_col).cast("string"))), F.lit(0))
    ).first()
    per_file = max(1, int(archive_bytes * count / (size + 400 * count))) if count else 1
    written = records(pages, id_col, url_col, html_col, least_bytes)
    written.write.option("lineSep", LINE + LINE).option("maxRecordsPerFile", per_file).text(path)


# --- reading ------------------------------------------------------------------------


def url_key(url: str) -> str:
    """The host's labels in reverse, then the rest in lower case, so that sites sort together."""
    rest = url.split("://", 1)[-1].split("#", 1)[0].lower()
    cut = min((rest.index(c) for c in "/?" if c in rest), default=len(rest))
    return ",".join(reversed(rest[:cut].split("."))) + ")" + (rest[cut:] or "/")


def parse_archive(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record, by declared lengths."""
    at, close = 0, (LINE + LINE).encode()
    while at < len(data):
        end = data.find(close, at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8").split(LINE)
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        start = end + len(close)
        stop = start + int(headers["content-length"])
        if data[stop : stop + len(close)] != close:
            raise ValueError(f"record at byte {at} is cut short")
        yield at, stop + len(close) - at, headers, data[start:stop]
        at = stop + len(close)


def _page_of(record_id: str | None) -> int | None:
    number = (record_id or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def _captures(run: str, data: bytes) -> Iterator[tuple]:
    for offset, length, headers, block in parse_archive(data):
        head, _, payload = block.partition((LINE + LINE).encode())
        fields = dict(x.partition(": ")[::2] for x in head.decode("utf-8").split(LINE)[1:])
        size, digest = int(fields["Content-Length"]), headers["warc-payload-digest"][len("sha256:") :]
        kind = headers["warc-type"]
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of the record at byte {offset} of {run} is damaged")
        url = headers.get("warc-target-uri")
        yield (
            run, url_key(url or ""), headers["warc-date"], _page_of(headers["warc-record-id"]), url, size, digest,
            kind, _page_of(headers.get("warc-refers-to")), offset, length,
        )


def _order(row: tuple) -> tuple:
    return row[1], row[2], row[3] is not None, row[3] or 0


_KINDS = [
    pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(),
    pa.int64(), pa.int64(), pa.int64(),
]
_NAMES = [field.split(" ")[0] for field in CAPTURE_SCHEMA.split(", ")]


def _batch(rows: list[tuple], names: list[str] = _NAMES, kinds: list = _KINDS) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.record_batch(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows = _captures(batch["path"][i].as_py(), batch["content"][i].as_py())
            yield _batch(sorted(rows, key=_order))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under ``path``, a sorted run per archive; payloads are verified."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read, CAPTURE_SCHEMA)


# --- merging ------------------------------------------------------------------------


class LoserTree:
    """k sorted runs as one: each inner node holds the loser of its match, the winner goes up."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.keys = [_order(h) if h is not None else None for h in self.heads]
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._build(1) if runs else -1

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an ended run never does; ties go to the earlier run."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _build(self, node: int) -> int:
        k = len(self.runs)
        if node >= k:
            return node - k
        left, right = self._build(2 * node), self._build(2 * node + 1)
        first, second = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = second
        return first

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self.keys[run] = _order(self.heads[run]) if self.heads[run] is not None else None
            node = (run + len(self.runs)) // 2
            while node >= 1:  # replay the matches on the way up
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[pa.RecordBatch]] = {}
    key_range = None
    for batch in batches:
        key_range = batch["key_range"][0].as_py() if batch.num_rows else key_range
        names = batch["run"].to_pylist()
        start = 0
        for i in range(1, len(names) + 1):  # rows come run by run
            if i == len(names) or names[i] != names[start]:
                runs.setdefault(names[start], []).append(batch.slice(start, i - start))
                start = i

    def rows(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for at in range(0, part.num_rows, 1024):
                block = part.slice(at, 1024).select(_NAMES).to_pydict()
                yield from zip(*(block[n] for n in _NAMES), strict=True)

    names, kinds = [*_NAMES, "key_range", "position"], [*_KINDS, pa.int32(), pa.int64()]
    out, position = [], 0
    for row in LoserTree([rows(parts) for _, parts in sorted(runs.items())]):
        out.append((*row, key_range, position))
        position += 1
        if len(out) == 4096:
            yield _batch(out, names, kinds)
            out = []
    if out:
        yield _batch(out, names, kinds)


def capture_histories(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs in one order: ``key_range`` and, within it, ``position``.

    Ranges are cut by URL key, time and id together, so the captures of a URL that has a large share of all
    are divided like any others. ``captures`` must be stored: it is read twice.
    """
    ship_package(captures.sparkSession)
    order = ["url_key", "captured", "page_id"]
    ranges = shards(captures.count(), range_rows)
    dealt = captures.repartitionByRange(ranges, *order)
    sorted_runs = dealt.withColumn("key_range", F.spark_partition_id()).sortWithinPartitions("run", *order)
    return sorted_runs.mapInArrow(_merge, CAPTURE_SCHEMA + ", key_range int, position bigint")


def archive_and_index(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES,
) -> DataFrame:
    """Write archives, read them back and return the merged capture index, a row per page.

    Null payloads are empty. Payloads under ``least_bytes`` are always responses; of larger equal ones the smallest id
    is the response. Rows that repeat an id and payload are captured each, alike. A row without an id is a
    response that nothing revisits. A page without a URL is indexed under the empty host. Line ends in a URL are
    percent-encoded; other columns are ignored; an empty table gives an empty index.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col, least_bytes)
    return capture_histories(stored(read_archives(spark, path), "warc-runs"))
