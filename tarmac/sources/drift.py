"""Tables whose deliveries change their columns: new columns are added, types grow wider, narrowing is refused.

The schema of such a table lies beside it (``path.schema``), since files of different ages have different columns. Reading
with it fills in columns that a file lacks and widens those that it has narrower.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.sources import files

# Each type, and those that hold all its values, as the Parquet reader widens them.
WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
}


class SchemaConflict(ValueError):
    """A delivery cannot be stored in the table without loss."""


def reconciled(held: T.StructType, given: T.StructType) -> T.StructType:
    """The schema of the table after a delivery: held columns in order, then new ones.

    A delivered type that holds all values of the stored one replaces it. A delivery may lack columns; its
    rows have nulls there. A narrower or an unrelated type is refused: the sender has changed its mind about what a
    column holds, and whether to cast is not for the loader to decide.
    """
    names = {f.name.lower(): f for f in given.fields}
    out = []
    for old in held.fields:
        new = names.pop(old.name.lower(), None)
        kind = old.dataType
        if new is not None and new.dataType != old.dataType:
            before, after = old.dataType.simpleString(), new.dataType.simpleString()
            if after not in WIDER.get(before, ()):
                narrower = before in WIDER.get(after, ())
                raise SchemaConflict(
                    f"column {old.name} is {before}; delivered as {after}, which "
                    + ("is narrower" if narrower else "does not hold all its values")
                )
            kind = new.dataType
        out.append(T.StructField(old.name, kind, True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in names.values()])


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}.schema"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema beside a table; None where there is none."""
    versions = [name for name, _ in files.children(spark, _folder(path)) if name.endswith(".json")]
    if not versions:
        return None
    return T.StructType.fromJson(json.loads(files.read_text(spark, f"{_folder(path)}/{versions[-1]}")))


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make a schema the table's; earlier ones stay beside it. Published by a rename."""
    number = len(files.children(spark, _folder(path)))
    hidden = f"{_folder(path)}/.{uuid.uuid4().hex}"
    files.write_text(spark, hidden, schema.json())
    files.rename(spark, hidden, f"{_folder(path)}/{number:06d}.json")


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns a delivery has, in the order and types of the table."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *(F.col(have[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema.fields if f.name.lower() in have)
    )
