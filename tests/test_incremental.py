"""Ledger, incremental Silver, header contract and schema drift."""

from __future__ import annotations

import os

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F
from test_sources import DATA, line, write_month

from tarmac.plans import jobs
from tarmac.sources import drift, files, ledger, raw, tables


def flight(number, day="2021-03-14", **fields):
    return line(FlightDate=day, Flight_Number_Reporting_Airline=str(number), **fields)


@pytest.fixture()
def lake(spark, tmp_path):
    """Three months in Bronze and Silver, and the airports."""
    root = str(tmp_path / "download")
    for month in (3, 4, 5):
        write_month(root, 2021, month, [flight(n, f"2021-0{month}-01", DepDelay="1.00") for n in range(4)])
    objects = '[{"iata": "N01", "country": "US", "lat": 1.0, "lon": 2.0, "name": "N01"}]'
    (tmp_path / "airports.json").write_text(objects)
    paths = {n: str(tmp_path / "lake" / n) for n in ("airports", "bronze", "silver")}
    jobs.load_airports(spark, str(tmp_path / "airports.json"), paths["airports"])
    jobs.load_bronze(spark, root, paths["bronze"])
    jobs.load_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    return root, paths


def stamps(path):
    """Name and time of every data file, by month folder."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found.setdefault(os.path.basename(folder), set()).add((name, os.stat(full).st_mtime_ns))
    return found


def same_as_rebuilt(spark, paths, tmp_path):
    again = str(tmp_path / "rebuilt")
    jobs.load_silver(spark, paths["bronze"], paths["airports"], again)
    columns = tables.read_table(spark, again).columns
    assert rows_of(tables.read_table(spark, paths["silver"]).select(*columns)) == rows_of(tables.read_table(spark, again))


def test_a_rerun_reads_no_bronze(spark, lake):
    root, paths = lake
    new = jobs.new_deliveries(spark, raw.landing_files(spark, root), paths["bronze"])
    assert new.count() == 0
    plan = plan_of(new)
    assert "bronze.ledger" in plan and "bronze/year" not in plan and "bronze]" not in plan
    before = stamps(paths["bronze"])
    jobs.extend_bronze(spark, root, paths["bronze"])
    assert stamps(paths["bronze"]) == before
    entries = ledger.entries(spark, paths["bronze"]).collect()
    assert sorted((e["month"], e["rows"], str(e["first_day"])) for e in entries) == [
        (3, 4, "2021-03-01"), (4, 4, "2021-04-01"), (5, 4, "2021-05-01"),
    ]


@pytest.mark.parametrize("renames", [0, 1, 2])
def test_a_load_that_breaks_off_is_undone_and_made_again(spark, lake, monkeypatch, renames):
    root, paths = lake
    write_month(root, 2021, 3, [flight(50)], name="late.csv")
    write_month(root, 2021, 6, [flight(60, "2021-06-01")], name="new.csv")
    plain, done = files.rename, []

    def breaking(spark, source, target):
        if len(done) >= renames:
            raise OSError("lost")
        done.append(target)
        plain(spark, source, target)

    monkeypatch.setattr(files, "rename", breaking)
    with pytest.raises(OSError):
        jobs.extend_bronze(spark, root, paths["bronze"])
    monkeypatch.setattr(files, "rename", plain)
    assert ledger.entries(spark, paths["bronze"]).filter("month = 6").count() == 0
    for _ in range(2):
        jobs.extend_bronze(spark, root, paths["bronze"])
    bronze = tables.read_table(spark, paths["bronze"])
    assert bronze.count() == 14
    assert bronze.select("source_file", "Flight_Number_Reporting_Airline").distinct().count() == 14
    assert not os.path.exists(paths["bronze"] + ".staging")


def test_a_table_without_a_ledger_gets_one(spark, lake):
    root, paths = lake
    files.delete(spark, paths["bronze"] + ".ledger")
    jobs.extend_bronze(spark, root, paths["bronze"])
    assert tables.read_table(spark, paths["bronze"]).count() == 12
    assert ledger.entries(spark, paths["bronze"]).count() == 3


def test_an_empty_file_counts_as_loaded(spark, lake):
    root, paths = lake
    write_month(root, 2021, 7, [], name="empty.csv")
    jobs.extend_bronze(spark, root, paths["bronze"])
    assert jobs.new_deliveries(spark, raw.landing_files(spark, root), paths["bronze"]).count() == 0


def test_refreshed_silver_equals_a_rebuild_and_leaves_other_months(spark, lake, tmp_path):
    root, paths = lake
    before = stamps(paths["silver"])
    assert jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"]) == []
    again = os.path.join(root, "year=2021", "month=4", "again.csv")
    write_month(root, 2021, 4, [flight(1, "2021-04-01", DepDelay="99.00"), flight(9, "2021-04-02")], name="again.csv")
    os.utime(again, (2_000_000_000, 2_000_000_000))
    jobs.extend_bronze(spark, root, paths["bronze"])
    written = jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    assert written == [(2021, 4)]
    after = stamps(paths["silver"])
    assert {m for m in after if after[m] != before[m]} == {"month=4"}
    silver = tables.read_table(spark, paths["silver"])
    assert rows_of(silver.filter("month = 4").select("Flight_Number_Reporting_Airline", "DepDelay"))[1] == (1, 99.0)
    same_as_rebuilt(spark, paths, tmp_path)
    assert jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"]) == []


def test_flights_that_move_between_months_and_rows_without_a_date(spark, lake, tmp_path):
    """A later filing in another folder takes the flight along, to the last one of its month."""
    root, paths = lake
    write_month(root, 2021, 6, [flight(7, "2021-06-01"), flight(8, "soon")], name="a.csv")
    jobs.extend_bronze(spark, root, paths["bronze"])
    jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    same_as_rebuilt(spark, paths, tmp_path)
    moved = os.path.join(root, "year=2021", "month=5", "moved.csv")
    write_month(root, 2021, 5, [flight(7, "2021-06-01", DepDelay="5.00"), flight(8, "never")], name="moved.csv")
    os.utime(moved, (2_000_000_000, 2_000_000_000))
    before = stamps(paths["silver"])
    jobs.extend_bronze(spark, root, paths["bronze"])
    written = jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    assert written == [(2021, 5), (2021, 6)]
    after = stamps(paths["silver"])
    assert after["month=3"] == before["month=3"] and after["month=4"] == before["month=4"]
    assert "month=6" not in after, "a month whose flights have all moved is emptied"
    same_as_rebuilt(spark, paths, tmp_path)


def test_a_refresh_that_breaks_off_is_made_again(spark, lake, tmp_path, monkeypatch):
    root, paths = lake
    write_month(root, 2021, 4, [flight(1, "2021-04-01", DepDelay="99.00")], name="again.csv")
    jobs.extend_bronze(spark, root, paths["bronze"])
    plain = ledger.take

    def lost(*args, **options):
        raise OSError("lost")

    monkeypatch.setattr(ledger, "take", lost)
    with pytest.raises(OSError):
        jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    monkeypatch.setattr(ledger, "take", plain)
    assert jobs.refresh_silver(spark, paths["bronze"], paths["airports"], paths["silver"]) == [(2021, 4)]
    same_as_rebuilt(spark, paths, tmp_path)


def test_no_copy_of_silver_stays_in_the_scratch_folder(spark, lake, monkeypatch):
    _, paths = lake
    made = []
    plain = tables.scratch_path
    monkeypatch.setattr(tables, "scratch_path", lambda s, n: made.append(plain(s, n)) or made[-1])
    jobs.load_silver(spark, paths["bronze"], paths["airports"], paths["silver"])
    assert made and not any(os.path.exists(m) for m in made)


@pytest.mark.parametrize(
    ("names", "problem"),
    [
        ([*DATA, ""], None),
        (DATA, None),
        ([f'"{n}"' for n in DATA], None),
        ([*DATA[:5], DATA[6], DATA[5], *DATA[7:]], f"field 6 is {DATA[6]}, not {DATA[5]}"),
        (DATA[:-1], "108 fields, not 109"),
        ([*DATA, "More", ""], "110 fields, not 109"),
    ],
)
def test_header_problems(names, problem):
    assert raw.header_problem(",".join(names)) == problem
    assert raw.header_problem("﻿" + ",".join(names)) == problem


def test_files_with_another_header_are_rejected_with_the_reason(spark, lake):
    root, paths = lake
    folder = os.path.join(root, "year=2021", "month=6")
    write_month(root, 2021, 6, [flight(1, "2021-06-01")], name="good.csv")
    swapped = [*DATA[:5], DATA[6], DATA[5], *DATA[7:], ""]
    for name, text in {"swapped.csv": ",".join(swapped) + "\n" + flight(2) + "\n", "none.csv": flight(3) + "\n"}.items():
        with open(os.path.join(folder, name), "w") as out:
            out.write(text)
    for _ in range(2):
        jobs.extend_bronze(spark, root, paths["bronze"])
        assert tables.read_table(spark, paths["bronze"]).count() == 13
        found = ledger.rejected(spark, paths["bronze"]).collect()
        assert sorted((os.path.basename(r["source_file"]), r["reason"]) for r in found) == [
            ("none.csv", "field 1 is , not Year"), ("swapped.csv", f"field 6 is {DATA[6]}, not {DATA[5]}"),
        ]
    # Delivered again in order, it is let in.
    write_month(root, 2021, 6, [flight(2, "2021-06-01")], name="swapped.csv")
    os.utime(os.path.join(folder, "swapped.csv"), (2_000_000_000, 2_000_000_000))
    jobs.extend_bronze(spark, root, paths["bronze"])
    assert tables.read_table(spark, paths["bronze"]).count() == 14


def test_reconciled_schemas(spark):
    def schema(ddl):
        return spark.createDataFrame([], ddl).schema

    held = schema("a int, b string, c double")
    assert drift.reconciled(held, schema("A bigint, d date")).simpleString() == "struct<a:bigint,b:string,c:double,d:date>"
    assert drift.reconciled(held, schema("b string")).simpleString() == held.simpleString()
    for given in ("a smallint", "a string", "c float", "b int", "c bigint"):
        with pytest.raises(drift.SchemaConflict):
            drift.reconciled(held, schema(given))


def test_deliveries_with_other_columns_read_back_as_one_table(spark, tmp_path):
    path = str(tmp_path / "t")

    def delivery(name, values, ddl):
        rows = spark.createDataFrame(values, ddl).withColumns(
            {"source_file": F.lit(name), "load_timestamp": F.timestamp_seconds(F.lit(1)), "FlightDate": F.lit("2021-03-01").cast("date"), "year": F.lit(2021), "month": F.lit(3)}
        )
        return rows, rows.select(*ledger.DELIVERY).distinct()

    ledger.load(*delivery("a", [(1, 2, "x")], "n int, m int, s string"), path, "FlightDate")
    ledger.load(*delivery("b", [(2**40, 0.5, "y")], "n bigint, m double, extra string"), path, "FlightDate")
    ledger.load(*delivery("c", [(2**41, "z")], "n bigint, extra string"), path, "FlightDate")
    table = tables.read_table(spark, path)
    assert dict(table.dtypes)["n"] == "bigint" and dict(table.dtypes)["m"] == "double"
    assert rows_of(table.select("n", "m", "s", "extra")) == [
        (1, 2.0, "x", None), (2**40, 0.5, None, "y"), (2**41, None, None, "z"),
    ]
    with pytest.raises(drift.SchemaConflict):
        ledger.load(*delivery("d", [(1,)], "n int"), path, "FlightDate")
    assert ledger.entries(spark, path).count() == 3 and tables.read_table(spark, path).count() == 3


def test_large_files_are_loaded_where_they_are_read(spark, lake, tmp_path, monkeypatch):
    root, paths = lake
    gathered = rows_of(tables.read_table(spark, paths["bronze"]))
    hints = []
    rows = tables.read_table(spark, paths["bronze"])
    monkeypatch.setattr(type(rows), "hint", lambda df, name, *_: hints.append(name) or df)
    monkeypatch.setattr(jobs, "LARGE_FILE", 1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    jobs.load_bronze(spark, root, str(tmp_path / "again"))
    assert not hints and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert rows_of(tables.read_table(spark, str(tmp_path / "again"))) == gathered
