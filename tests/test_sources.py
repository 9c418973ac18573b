from __future__ import annotations

import datetime as dt
import glob
import gzip
import json
import os

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from tarmac.model import CORRUPT_FIELD, FLIGHT_COLUMNS, RAW_FLIGHT_FIELDS
from tarmac.operators import completeness
from tarmac.operators.dedup import latest_filing
from tarmac.plans import jobs
from tarmac.plans.bronze import bronze_flights
from tarmac.session import scratch_path, shared_folder
from tarmac.sources import catalog, raw, tables
from tarmac.streaming.ingest import ingest_new_files

DATA = [name for name, _ in RAW_FLIGHT_FIELDS[:-2]]


def test_raw_schema():
    kinds = [kind for _, kind in RAW_FLIGHT_FIELDS]
    assert len(kinds) == 111 and len(DATA) == 109 and len(FLIGHT_COLUMNS) == 37
    assert [kinds.count(k) for k in ("INT", "DOUBLE", "STRING", "DATE")] == [47, 37, 26, 1]


def line(**fields):
    ordinary = {"FlightDate": "2021-03-14", "Reporting_Airline": "AA", "Origin": "N01", "Dest": "N02"}
    values = ordinary | fields
    return ",".join(f'"{values[n]}"' if n in values else "" for n in DATA) + ","


def write_month(root, year, month, lines, name="a.csv"):
    folder = os.path.join(root, f"year={year}", f"month={month}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join([",".join(DATA) + ",", *lines]) + "\n")


@pytest.fixture()
def landing(tmp_path):
    root = str(tmp_path / "download")
    write_month(
        root, 2021, 3,
        [
            line(DepDelay="5.00", Flight_Number_Reporting_Airline="1"),
            line(DepDelay="late", Flight_Number_Reporting_Airline="2"),
            line(DepDelay="", Tail_Number="", Flight_Number_Reporting_Airline="3"),
            "2021,1,3",
            line(FlightDate="soon", Flight_Number_Reporting_Airline="4"),
        ],
    )
    write_month(root, 2021, 4, [line(FlightDate="2021-04-01", Flight_Number_Reporting_Airline="5")])
    return root


def test_landing_scan_types_fields_and_marks_bad_lines(spark, landing, tmp_path):
    scanned = bronze_flights(raw.required_columns(raw.read_landing(spark, landing)))
    path = str(tmp_path / "bronze")
    tables.write_partitioned(scanned, path)
    rows = {r.Flight_Number_Reporting_Airline: r for r in tables.read_table(spark, path).collect()}
    assert rows[1].DepDelay == 5.0 and rows[1].FlightDate == dt.date(2021, 3, 14)
    assert rows[1].corrupt_record is None and rows[5].corrupt_record is None
    assert rows[3].DepDelay is None and rows[3].Tail_Number is None
    assert rows[3].corrupt_record is None, "empty fields are missing values, not errors"
    assert rows[2].DepDelay is None and '"late"' in rows[2].corrupt_record
    assert rows[None].corrupt_record == "2021,1,3"
    assert rows[4].FlightDate is None and rows[4].year is None and rows[4].corrupt_record
    assert len(rows) == 6


def test_without_the_trailing_field_every_line_is_corrupt(spark, landing):
    fields = [f for f in RAW_FLIGHT_FIELDS if f[0] != "_c109"]
    schema = ", ".join(f"{n} {k}" for n, k in fields)
    df = spark.read.schema(schema).options(**raw.CSV_OPTIONS).csv(f"{landing}/*/*/")
    checked = df.select(*FLIGHT_COLUMNS, CORRUPT_FIELD).cache()
    assert checked.filter(F.col(CORRUPT_FIELD).isNull()).count() <= 1
    checked.unpersist()


def test_written_landing_reads_back(spark, make_flights, tmp_path):
    flights = make_flights({}, {"FlightDate": dt.date(2022, 1, 2), "Tail_Number": None}).drop("load_timestamp")
    root = str(tmp_path / "download")
    raw.write_landing(flights, root)
    assert sorted(os.listdir(root))[-2:] == ["year=2021", "year=2022"]
    back = raw.required_columns(raw.read_landing(spark, root))
    assert rows_of(back.drop(CORRUPT_FIELD)) == rows_of(flights)
    assert {row[CORRUPT_FIELD] for row in back.collect()} == {None}


def test_airport_json(spark, tmp_path):
    objects = [
        {"iata": "N01", "country": "US", "lat": 1.5, "lon": 2.5, "elevation": 12, "name": "One"},
        {"iata": "N02", "country": "CA", "lat": None, "lon": None, "name": "Two"},
    ]
    (tmp_path / "airports.json").write_text(json.dumps(objects, indent=2))
    df = raw.read_airport_json(spark, str(tmp_path))
    assert len(df.columns) == 11 and dict(df.dtypes)["elevation"] == "bigint"
    assert rows_of(df.select("iata", "elevation", "lat")) == [("N01", 12, 1.5), ("N02", None, None)]
    assert set(raw.read_airport_json(spark, str(tmp_path), infer=True).columns) == set(objects[0])


@pytest.fixture()
def monthly(make_flights):
    return bronze_flights(
        make_flights(*({"FlightDate": dt.date(2021, m, 1), "DepDelay": float(m)} for m in (1, 2, 3, 12)))
    )


def test_reading_months_prunes_partitions(spark, monthly, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(monthly, path)
    part = tables.read_months(spark, path, (2021, 2), (2021, 11))
    assert rows_of(part.select("month")) == [(2,), (3,)]
    filters = plan_of(part).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "month#" in filters and "year#" in filters


def test_overwriting_partitions_keeps_the_others(spark, monthly, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(monthly, path)
    again = monthly.filter("month = 2").withColumn("DepDelay", F.lit(99.0))
    for _ in range(2):
        tables.write_partitioned(again, path, replace="partitions")
    got = rows_of(tables.read_table(spark, path).select("month", "DepDelay"))
    assert got == [(1, 1.0), (12, 12.0), (2, 99.0), (3, 3.0)]
    tables.write_partitioned(again, path)
    assert tables.read_table(spark, path).count() == 1


def test_clustered_files_are_sorted_and_complete(spark, make_flights, tmp_path):
    path = str(tmp_path / "t")
    rows = make_flights(
        *({"Origin": o, "Flight_Number_Reporting_Airline": n} for n, o in enumerate("CABAC" * 4))
    ).withColumns({"airline_code": F.lit("AA"), "origin_code": F.col("Origin"), "year": F.lit(2021), "month": F.lit(3)})
    tables.write_clustered(rows, path)
    back = tables.read_table(spark, path)
    assert back.count() == 20
    found = plan_of(back.filter("origin_code = 'B'"))
    assert "EqualTo(origin_code,B)" in found.split("PushedFilters")[1]


def test_difference_counts(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    assert tuple(tables.difference_counts(a, b, "t").first()) == ("t", 3, 3, 1, 1)
    assert tuple(tables.difference_counts(a, a, "t").first()) == ("t", 3, 3, 0, 0)


def test_months_missing_and_loaded(spark):
    grid = completeness.month_grid(spark, "2020-11-01", "2021-02-01")
    held = spark.createDataFrame([(2020, 12), (2021, 2), (1999, 1)], "year int, month int")
    assert rows_of(completeness.missing_months(grid, held)) == [(2020, 11), (2021, 1)]
    files = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "file string, time int")
    loaded = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "file string, time int")
    new = completeness.not_yet_loaded(files, loaded, ["file", "time"])
    assert rows_of(new) == [("a", 2), ("b", 1)]


def test_catalog(spark, monthly, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(monthly, path)
    name = f"db_{os.path.basename(scratch_path(spark, 'x')).split('-')[1]}"
    catalog.use_database(spark, name, str(tmp_path / "db"))
    external = catalog.register_external(spark, name, "flights", path)
    assert catalog.row_count(spark, external).first().row_count == 4
    saved = catalog.save_managed(monthly.select("month"), name, "months")
    assert rows_of(spark.table(saved)) == [(1,), (12,), (2,), (3,)]


def test_shared_folder_is_required_on_a_cluster(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Session:
        sparkContext = Context()

    unset, named = Session(), Session()
    unset.conf, named.conf = Conf(None), Conf("/shared/folder/")
    with pytest.raises(ValueError):
        shared_folder(unset)
    assert shared_folder(named) == "/shared/folder"
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_streamed_files_are_loaded_once(spark, landing, tmp_path):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    ingest_new_files(spark, landing, path, checkpoint)
    assert tables.read_table(spark, path).count() == 6
    ingest_new_files(spark, landing, path, checkpoint)
    assert tables.read_table(spark, path).count() == 6
    write_month(landing, 2021, 5, [line(FlightDate="2021-05-01")])
    ingest_new_files(spark, landing, path, checkpoint)
    got = tables.read_table(spark, path)
    assert got.count() == 7 and got.filter("load_timestamp is null").count() == 0
    assert got.select("source_file").distinct().count() == 3


def test_batch_jobs_and_streaming_take_turns_on_one_table(spark, landing, tmp_path):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    expected = 6

    def check():
        got = tables.read_table(spark, path)
        assert got.count() == expected
        assert got.select("source_file", "Flight_Number_Reporting_Airline").distinct().count() == expected

    jobs.load_bronze(spark, landing, path)
    check()
    for n, step in enumerate(("stream", "batch", "stream", "batch")):
        write_month(
            landing, 2021, 3, [line(Flight_Number_Reporting_Airline=str(50 + n))], name=f"late{n}.csv"
        )
        expected += 1
        for _ in range(2):
            if step == "stream":
                ingest_new_files(spark, landing, path, checkpoint)
            else:
                jobs.extend_bronze(spark, landing, path)
            check()


def test_late_files_and_bad_dates_of_held_months_are_kept(spark, landing, tmp_path):
    path = str(tmp_path / "bronze")
    jobs.load_bronze(spark, landing, path)
    late = [line(FlightDate="later", Flight_Number_Reporting_Airline="8"), line(Flight_Number_Reporting_Airline="9")]
    write_month(landing, 2021, 3, late, name="b.csv")
    for _ in range(2):
        jobs.extend_bronze(spark, landing, path)
    rows = tables.read_table(spark, path).select("year", "month", "FlightDate", "Flight_Number_Reporting_Airline")
    assert rows.filter("year = 2021 and month = 3").count() == 7
    assert rows.filter("FlightDate is null").count() == 3 and rows.count() == 8


def test_a_file_delivered_again_supersedes_its_first_delivery(spark, landing, tmp_path):
    path = str(tmp_path / "bronze")
    jobs.load_bronze(spark, landing, path)
    again = os.path.join(landing, "year=2021", "month=4", "a.csv")
    write_month(landing, 2021, 4, [line(FlightDate="2021-04-01", Flight_Number_Reporting_Airline="5", DepDelay="99.00")])
    os.utime(again, (2_000_000_000, 2_000_000_000))
    jobs.extend_bronze(spark, landing, path)
    bronze = tables.read_table(spark, path)
    assert bronze.filter("month = 4").count() == 2
    kept = latest_filing(bronze).filter("month = 4").collect()
    assert [r.DepDelay for r in kept] == [99.0]


def test_extending_opens_only_new_files(spark, landing, tmp_path, monkeypatch):
    path, read = str(tmp_path / "bronze"), []
    jobs.load_bronze(spark, landing, path)
    write_month(landing, 2021, 5, [line(FlightDate="2021-05-01")], name="new.csv")
    plain = raw.read_flight_csv
    monkeypatch.setattr(raw, "read_flight_csv", lambda s, files: read.extend(files) or plain(s, files))
    for _ in range(2):
        jobs.extend_bronze(spark, landing, path)
    assert [os.path.basename(f) for f in read] == ["new.csv"]


def test_jobs_end_to_end(spark, landing, tmp_path):
    (tmp_path / "airports").mkdir()
    objects = [{"iata": i, "country": "US", "lat": 1.0 * n, "lon": 2.0, "name": i} for n, i in enumerate(["N01", "N02"])]
    (tmp_path / "airports" / "a.json").write_text(json.dumps(objects))
    paths = {n: str(tmp_path / "lake" / n) for n in ("airports", "bronze", "silver", "db")}
    jobs.load_airports(spark, str(tmp_path / "airports"), paths["airports"])
    jobs.load_bronze(spark, landing, paths["bronze"])
    write_month(landing, 2021, 5, [line(FlightDate="2021-05-01"), line(FlightDate="2021-05-01")])
    for _ in range(2):
        jobs.extend_bronze(spark, landing, paths["bronze"])
    bronze = tables.read_table(spark, paths["bronze"])
    assert bronze.count() == 8 and bronze.filter("year is null or month is null").count() == 0
    jobs.load_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    silver = tables.read_table(spark, paths["silver"])
    assert silver.filter("month = 5").count() == 1
    assert len(silver.columns) == 83
    name = f"db_{os.path.basename(scratch_path(spark, 'x')).split('-')[1]}"
    catalog.use_database(spark, name, paths["db"])
    saved = jobs.load_gold(spark, paths["silver"], paths["airports"], name, cache=True)
    assert [spark.table(t).count() > 0 for t in saved] == [True, True, True, False]


def test_a_month_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.lit(2021).alias("year"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 12 + 1).cast("int").alias("month"),
    )
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        tables.write_partitioned(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{path}/year=2021/month=1") if f.endswith(".parquet")]
    assert len(files) > 3
    assert tables.read_table(spark, path).count() == 200_000


def test_landing_files_are_small_and_their_headers_are_read(spark, make_flights, tmp_path):
    root = str(tmp_path / "landing")
    raw.write_landing(make_flights(*({"Flight_Number_Reporting_Airline": n} for n in range(500))), root)
    paths = glob.glob(f"{root}/*/*/*.csv*")
    assert raw.header_problems(spark, paths) == [None] * len(paths)
    lines = [line for path in paths for line in gzip.open(path, "rt")]
    assert len(lines) == 500 + len(paths)
    assert sum(map(os.path.getsize, paths)) * 4 < sum(map(len, lines))


def test_empty_landing_fields_are_not_shuffled(spark, make_flights, tmp_path, monkeypatch):
    widths = []
    rows = make_flights({})
    hint = type(rows).hint

    def noted(df, name, *parameters):
        widths.append(len(df.columns))
        return hint(df, name, *parameters)

    monkeypatch.setattr(type(rows), "hint", noted)
    raw.write_landing(rows, str(tmp_path / "landing"))
    assert widths and max(widths) <= len(FLIGHT_COLUMNS) + 3
