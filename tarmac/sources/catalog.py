"""Catalog: databases, external and managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.sources import files


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database where it does not exist; ``location`` places its tables."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def register_external(
    spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet"
) -> str:
    """Register the files at ``path`` as a table, partitions included."""
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if spark.table(name).schema.names and _is_partitioned(spark, database, table):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def _is_partitioned(spark: SparkSession, database: str, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(f"`{database}`.`{table}`"))


def save_managed(df: DataFrame, database: str, table: str, fmt: str = "parquet") -> str:
    name = f"`{database}`.`{table}`"
    df.write.format(fmt).mode("overwrite").saveAsTable(name)
    return name


def publish_together(
    frames: dict[str, DataFrame], database: str, root: str, fmt: str = "parquet", keep: int = 2
) -> list[str]:
    """Write tables as one new version below ``root`` and show it under their names; returns the names.

    Nothing that readers see changes before the last table is written. Then one rename makes the version the current
    one (``current_version``), and each name becomes a view of its files, without any rows moving. A job that ends
    before leaves the old version in place; what it has written is deleted by the next. ``keep`` versions stay, so
    that queries under way can finish.
    """
    spark = next(iter(frames.values())).sparkSession
    root = root.rstrip("/")
    current = current_version(spark, root)
    held = [name for name, _ in files.children(spark, root) if name.startswith("v")]
    for broken in (name for name in held if current is None or name > current):
        files.delete(spark, f"{root}/{broken}")
    version = f"v{int(current[1:]) + 1 if current else 1:08d}"
    for name, df in frames.items():
        df.write.format(fmt).mode("error").save(f"{root}/{version}/{name}")
    _point_to(spark, root, version)
    names = show_version(spark, list(frames), database, root, version, fmt)
    done = sorted(name for name in held if current and name <= current)
    for old in done[: max(0, len(done) + 1 - keep)]:
        files.delete(spark, f"{root}/{old}")
    return names


def show_version(
    spark: SparkSession, tables: list[str], database: str, root: str, version: str, fmt: str = "parquet"
) -> list[str]:
    """Make the names in the database views of a version's files; also to go back to an earlier one."""
    names = []
    for table in tables:
        name = f"`{database}`.`{table}`"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{root}/{version}/{table}`")
        names.append(name)
    return names


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that was last written in full."""
    found = [name for name, _ in files.children(spark, root) if name.startswith("current-")]
    return max(found).removeprefix("current-") if found else None


def _point_to(spark: SparkSession, root: str, version: str) -> None:
    before = [name for name, _ in files.children(spark, root) if name.startswith("current-")]
    files.write_text(spark, f"{root}/.next", version)
    files.rename(spark, f"{root}/.next", f"{root}/current-{version}")
    for name in before:
        files.delete(spark, f"{root}/{name}")


def row_count(spark: SparkSession, table: str) -> DataFrame:
    """One row: the number of rows of a table, asked in SQL."""
    return spark.sql(f"SELECT count(*) AS row_count FROM {table}")
