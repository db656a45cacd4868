"""Small text files and folders in any store that Spark reads, through the file systems Spark knows."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    system, where = _at(spark, path)
    return system.exists(where)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or None when there is none."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    system, where = _at(spark, path)
    stream = system.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a file. Readers see the old text or the new one; in between the file may be absent."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    _create(spark, hidden, text)
    system, where = _at(spark, path)
    system.delete(where, False)
    if not rename(spark, hidden, path):
        raise OSError(f"{path} was written by someone else at the same time")


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file as a whole; False when there is one by that name already."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    _create(spark, hidden, text)
    if not path_exists(spark, path) and rename(spark, hidden, path):
        return True
    delete(spark, hidden)
    return False


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a file or folder; False when there is something under the new name."""
    system, where = _at(spark, old)
    _, target = _at(spark, new)
    if system.exists(target):
        return False
    system.mkdirs(target.getParent())
    return system.rename(where, target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    system, where = _at(spark, path)
    system.delete(where, True)


def names_in(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names in a folder, each with whether it is a folder; none when there is no such folder. Hidden names are left out,
    and so are those that data readers skip, unless they hold a partition value."""
    system, where = _at(spark, folder)
    if not system.exists(where):
        return []
    found = [(f.getPath().getName(), f.isDirectory()) for f in system.listStatus(where)]
    return sorted((name, is_folder) for name, is_folder in found if name[0] not in "._" or ("=" in name and name[0] == "_"))


def partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Relative names of the ``column=value`` folders ``depth`` levels down."""
    if not depth:
        return [""]
    found = []
    for name, is_folder in names_in(spark, folder):
        if is_folder and "=" in name:
            found += [f"{name}/{x}".rstrip("/") for x in partition_folders(spark, f"{folder}/{name}", depth - 1)]
    return found
