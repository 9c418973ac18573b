"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings a session for this package wants; cluster sizing stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Percentile sketches are aggregated per airline-month. A task meets more than the
    # default 128 groups and would otherwise sort its whole input; a sketch is small.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "12g"):
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarmac")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
        # The given tables have one row group each, hence one scan task. A smaller
        # broadcast bound shuffles the larger ones, which puts all cores to work.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds for a while."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile delete their shuffle files as they end.

    Otherwise these stay until the driver happens to collect its garbage, so that a job of several steps has those of all
    of them on disk. A plan that runs again makes its shuffles again.
    """
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


@functools.cache
def _local_folder(application_id: str) -> str:
    """A folder that goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="tarmac-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a
    cluster must name one, since executors do not share a machine's disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(context.applicationId)


_handed_out: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this process put in the shared folder; nothing may read it any more."""
    while _handed_out:
        target = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
