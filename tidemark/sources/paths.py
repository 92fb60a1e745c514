"""Existence and removal of paths through the Hadoop file system of the session."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _file_system(spark, path)
    if any(mark in path for mark in "*?[{"):
        return bool(file_system.globStatus(target))
    return file_system.exists(target)


def literal_path(path: str) -> str:
    """The path as a reader takes it, where a name may hold the marks of a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of visible entries of a directory; none if it is missing."""
    file_system, target = _file_system(spark, path)
    if not file_system.exists(target):
        return []
    names = [status.getPath().getName() for status in file_system.listStatus(target)]
    return [name for name in names if not name.startswith(("_", "."))]


def child_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the visible files of a directory; none if it is missing."""
    file_system, target = _file_system(spark, path)
    if not file_system.exists(target):
        return []
    files = [status for status in file_system.listStatus(target) if status.isFile()]
    return [status.getLen() for status in files if not status.getPath().getName().startswith(("_", "."))]


def has_entries(spark: SparkSession, path: str) -> bool:
    """Whether a written table directory holds anything but the commit marker."""
    return bool(child_names(spark, path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes one small file, replacing what is there."""
    file_system, target = _file_system(spark, path)
    stream = file_system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file unless there is one of the new name; returns whether it did. Where the
    file system renames atomically, one of several callers succeeds."""
    file_system, new = _file_system(spark, target)
    old = file_system.makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source))
    file_system.mkdirs(new.getParent())
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(file_system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(old, file_system.makeQualified(new), no_overwrite)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def remove_path(spark: SparkSession, path: str) -> None:
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)
