"""Reading an exported table back as a query, as a serving system would answer it: a data source with pushed filters.

The source reads the Parquet files of an export itself, by partitions of row groups, and takes the comparisons of the
query over, so only matching rows reach Spark. It needs no server and no jar. Paths are those of
``pyarrow`` file systems (local, ``hdfs://``, ``s3://``, ``gs://``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as source
from pyspark.sql.types import StructType

NAME = "exported"
# Row groups read by one task, on average.
GROUPS_PER_TASK = 8

_COMPARISONS = {
    source.EqualTo: "==",
    source.GreaterThan: ">",
    source.GreaterThanOrEqual: ">=",
    source.LessThan: "<",
    source.LessThanOrEqual: "<=",
}


class RowGroups(source.InputPartition):
    """Some row groups of one file."""

    def __init__(self, file: str, groups: Sequence[int]):
        self.file, self.groups = file, list(groups)


class ExportReader(source.DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns
        self.conditions: list[tuple] = []

    def pushFilters(self, filters: list[source.Filter]) -> Iterable[source.Filter]:
        """Comparisons of top-level columns with values are answered here; Spark keeps the rest."""
        for one in filters:
            name = getattr(one, "attribute", ())
            if len(name) == 1 and type(one) in _COMPARISONS:
                self.conditions.append((name[0], _COMPARISONS[type(one)], one.value))
            elif len(name) == 1 and isinstance(one, source.In):
                self.conditions.append((name[0], "in", tuple(one.value)))
            elif len(name) == 1 and isinstance(one, source.IsNotNull):
                self.conditions.append((name[0], "valid", None))
            else:
                yield one

    def _dataset(self):
        import pyarrow.dataset
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.path) if "://" in self.path else (None, self.path.removeprefix("file:"))
        return pyarrow.dataset.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=False)

    def _condition(self):
        import pyarrow.dataset as ds

        whole = None
        for name, kind, value in self.conditions:
            field = ds.field(name)
            one = {
                "==": lambda f, v: f == v, ">": lambda f, v: f > v, ">=": lambda f, v: f >= v, "<": lambda f, v: f < v,
                "<=": lambda f, v: f <= v, "in": lambda f, v: f.isin(list(v)), "valid": lambda f, v: f.is_valid(),
            }[kind](field, value)
            whole = one if whole is None else whole & one
        return whole

    def partitions(self) -> list[RowGroups]:
        """Row groups whose statistics can meet the conditions; only footers are read."""
        found = []
        for fragment in self._dataset().get_fragments():
            condition = self._condition()
            groups = [g.id for f in fragment.split_by_row_group(condition) for g in f.row_groups]
            for at in range(0, len(groups), GROUPS_PER_TASK):
                found.append(RowGroups(fragment.path, groups[at : at + GROUPS_PER_TASK]))
        return found or [RowGroups("", [])]

    def read(self, partition: RowGroups) -> Iterator:
        if not partition.groups:
            return
        dataset = self._dataset()
        whole = next(f for f in dataset.get_fragments() if f.path == partition.file)
        part = whole.subset(row_group_ids=partition.groups)
        yield from part.to_batches(schema=dataset.schema, columns=self.columns, filter=self._condition(), use_threads=False)


class ExportSource(source.DataSource):
    """``spark.read.format("exported").option("path", ...)``: the Parquet files of an exported table."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        raise NotImplementedError("read_export hands the schema of the files over")

    def reader(self, schema: StructType) -> ExportReader:
        return ExportReader(self.options["path"], schema.names)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The table exported to ``path``, through the data source."""
    # The classes travel by value: workers need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ExportSource)
    schema = spark.read.parquet(path).schema
    return spark.read.format(NAME).schema(schema).option("path", path).load()


def query_export(spark: SparkSession, path: str, query: str) -> DataFrame:
    """What an exported table answers to a query, in which ``{table}`` stands for it."""
    return spark.sql(query, table=read_export(spark, path))
