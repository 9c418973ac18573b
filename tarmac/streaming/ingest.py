"""Landing files to Bronze as they arrive, through the writer of the batch jobs.

The only streaming there is. The checkpoint remembers which files were seen; each
batch is written by the batch writer, which leaves out files that the ledger of Bronze has. So
a batch that is repeated after a failure adds nothing twice, and batch jobs and
streaming may take turns on one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.model import RAW_FLIGHT_SCHEMA
from tarmac.plans.jobs import append_lines
from tarmac.sources.raw import CSV_OPTIONS, LANDING_GLOB, with_delivery


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    fmt: str = "parquet",
) -> None:
    """Append the files that arrived since the last run to Bronze, then return."""

    def write(batch: DataFrame, _: int) -> None:
        append_lines(batch, path, fmt)

    lines = (
        spark.readStream.schema(RAW_FLIGHT_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(f"{landing.rstrip('/')}/{LANDING_GLOB}")
    )
    run = (
        with_delivery(lines)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
