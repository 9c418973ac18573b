"""Small file operations wherever Spark can reach: existence, listing, renaming, short texts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _path(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder; nothing happens where there is none."""
    system, target = _path(spark, path)
    system.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename, with the folders above the target made where they lack."""
    system, old = _path(spark, source)
    new = _path(spark, target)[1]
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of what lies in a folder; empty where there is none."""
    system, target = _path(spark, path)
    if not system.exists(target):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in system.listStatus(target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _path(spark, path)
    out = system.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _path(spark, path)
    reader = spark._jvm.java.io.InputStreamReader(system.open(target), "UTF-8")
    buffered = spark._jvm.java.io.BufferedReader(reader)
    try:
        lines = []
        while (line := buffered.readLine()) is not None:
            lines.append(line)
        return "\n".join(lines)
    finally:
        buffered.close()


def first_lines(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str | None]:
    """The first line of each file, read without the rest; None for an empty file. Compressed ones are known by their names."""
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())

    def first(path: str) -> str | None:
        system, target = _path(spark, path)
        codec, stream = codecs.getCodec(target), system.open(target)
        reader = spark._jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        buffered = spark._jvm.java.io.BufferedReader(reader)
        try:
            return buffered.readLine()
        finally:
            buffered.close()

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(first, paths))
