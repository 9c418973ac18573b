"""Raw landing files: monthly flight CSV and airport JSON."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.model import (
    AIRPORT_SCHEMA,
    CORRUPT_FIELD,
    FLIGHT_COLUMNS,
    RAW_FLIGHT_FIELDS,
    RAW_FLIGHT_SCHEMA,
    TRAILING_FIELD,
)
from tarmac.session import released_shuffles, setting
from tarmac.sources import files

# Column pruning stays off: a pruned scan parses only the columns a query reads
# and would then report fewer corrupt lines than there are.
CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "nullValue": "",
    "emptyValue": "",
    "enforceSchema": "true",
    "columnNameOfCorruptRecord": CORRUPT_FIELD,
    "columnPruning": "false",
}

LANDING_GLOB = "*/*/"

# What ingest adds to each row: the file it came from, the time that file was delivered, its folder.
SOURCE_FILE = "source_file"
FOLDER = ("folder_year", "folder_month")


def read_flight_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """All raw fields of the files at ``path`` (a glob or a list is fine), typed by position."""
    return spark.read.schema(RAW_FLIGHT_SCHEMA).options(**CSV_OPTIONS, **options).csv(path)


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """The raw files below ``root/year=YYYY/month=M/``."""
    return read_flight_csv(spark, f"{root.rstrip('/')}/{LANDING_GLOB}")


def with_delivery(lines: DataFrame) -> DataFrame:
    """The required columns with file, delivery time (``load_timestamp``) and folder of each line."""
    file = F.col("_metadata.file_path")

    def folder(name: str):
        return F.regexp_extract(file, f"/{name}=([0-9]+)/", 1).try_cast("int").alias(f"folder_{name}")

    return lines.select(
        *FLIGHT_COLUMNS,
        CORRUPT_FIELD,
        file.alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias("load_timestamp"),
        folder("year"),
        folder("month"),
    )


# The names a landing file has to begin with, in order.
HEADER = [name for name, _ in RAW_FLIGHT_FIELDS if name not in (TRAILING_FIELD, CORRUPT_FIELD)]


def header_problem(line: str | None) -> str | None:
    """Why the first line of a file does not name the expected fields in their order; None where it does.

    Fields are read by position, so a file with other fields, or the same in another order, would
    load wrong values without an error. The empty name after the comma that ends every line may lack.
    """
    if not line:
        return "no header"
    names = [name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")]))]
    if names[-1] == "":
        names.pop()
    for place, (found, wanted) in enumerate(zip(names, HEADER), start=1):
        if found != wanted:
            return f"field {place} is {found}, not {wanted}"
    return None if len(names) == len(HEADER) else f"{len(names)} fields, not {len(HEADER)}"


def header_problems(spark: SparkSession, paths: list[str]) -> list[str | None]:
    """The problem of each file's header. Only the first line of a file is read."""
    return [header_problem(line) for line in files.first_lines(spark, paths)]


def landing_files(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, load_timestamp) of every landing file; a listing, no file is opened."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{LANDING_GLOB}")
    return files.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias("load_timestamp"),
    )


def mean_size(spark: SparkSession, paths: list[str]) -> float:
    """Bytes of a landing file on average; a listing, no file is opened."""
    found = spark.read.format("binaryFile").load(paths)
    return found.select(F.col("_metadata.file_size").alias("size")).agg(F.avg("size")).first()[0] or 0.0


def required_columns(raw: DataFrame) -> DataFrame:
    """The columns Bronze keeps, and the text of lines that did not parse."""
    return raw.select(*FLIGHT_COLUMNS, CORRUPT_FIELD)


def write_landing(
    flights: DataFrame,
    root: str,
    day: str = "FlightDate",
    mode: str = "error",
    names: Mapping[str, str] = MappingProxyType({}),
    compression: str = "gzip",
) -> None:
    """Flights as raw CSV below ``root/year=YYYY/month=M/``, foldered by the date in ``day``.

    ``names`` gives fields another name in the header. Fields the input lacks are written empty, and each line ends with a comma. ``Year`` and ``year`` are
    a field and a folder, so names are told apart by case while this writes. A month is spread over as
    many tasks as its size asks for (``rebalance``), however large it is. Rows are shuffled and sorted with the columns
    they have, and the empty fields are added as they are written. Most fields are empty, so files are compressed.
    """
    have = set(flights.columns)
    used = {name for name, _ in RAW_FLIGHT_FIELDS if name in have} - {CORRUPT_FIELD}
    date = F.col("_day")
    derived = {
        "Year": F.year(date),
        "Quarter": F.quarter(date),
        "Month": F.month(date),
        "DayofMonth": F.dayofmonth(date),
    }
    fields = []
    for name, kind in RAW_FLIGHT_FIELDS:
        if name == CORRUPT_FIELD:
            continue
        if name in have:
            value = F.col(name)
        else:
            value = derived.get(name, F.lit(None).cast(kind))
        fields.append(value.alias("" if name == TRAILING_FIELD else names.get(name, name)))
    with setting(flights.sparkSession, "spark.sql.caseSensitive", "true"), released_shuffles(flights.sparkSession):
        rows = flights.select(*(c for c in flights.columns if c in used), F.col(day).alias("_day"))
        rows = rows.withColumns({"_year": F.year("_day"), "_month": F.month("_day")})
        (
            rows.hint("rebalance", "_year", "_month")
            .sortWithinPartitions("_year", "_month")
            .select(*fields, F.col("_year").alias("year"), F.col("_month").alias("month"))
            .write.mode(mode)
            .partitionBy("year", "month")
            .options(header="true", emptyValue="", compression=compression)
            .csv(root)
        )


def read_airport_json(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """The airport dimension from files that each hold one JSON array of objects."""
    reader = spark.read.option("multiLine", "true")
    return (reader if infer else reader.schema(AIRPORT_SCHEMA)).json(path)


__all__ = [
    "CSV_OPTIONS",
    "FOLDER",
    "HEADER",
    "LANDING_GLOB",
    "SOURCE_FILE",
    "TRAILING_FIELD",
    "header_problem",
    "header_problems",
    "landing_files",
    "mean_size",
    "read_airport_json",
    "read_flight_csv",
    "read_landing",
    "required_columns",
    "with_delivery",
    "write_landing",
]
