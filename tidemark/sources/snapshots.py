"""Landed source files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.fingerprint import fingerprint


def read_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """One row ``(path, modificationTime, length, content)`` per file that is not empty."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.load(path)


def fingerprint_files(
    spark: SparkSession, path: str | list[str], glob: str | None = None, by: str = "content"
) -> DataFrame:
    """``(path, sha256, size)`` per landed file.

    ``by="content"`` hashes the bytes, for workbooks and other whole-file sources.
    ``by="listing"`` hashes path, length and modification time: the content column is
    pruned, so a drop of many large files is fingerprinted without reading it.
    """
    files = read_files(spark, path, glob)
    if by == "content":
        return fingerprint(files)
    if by != "listing":
        raise ValueError("by must be 'content' or 'listing'")
    modified = F.unix_micros("modificationTime").cast("string")
    listed = F.concat_ws("|", "path", F.col("length").cast("string"), modified)
    return files.select("path", F.sha2(listed, 256).alias("sha256"), F.col("length").alias("size"))
