"""Hashes of source snapshots, and whether they changed since the last version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprint(files: DataFrame) -> DataFrame:
    """``(path, sha256, size)`` of a table of ``(path, content BINARY)``."""
    return files.select(
        "path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("size")
    )


def combined_fingerprint(fingerprints: DataFrame) -> DataFrame:
    """One row ``(sha256, file_count, size)`` for a snapshot of any number of files.

    A single file keeps its own hash. Several are combined by adding up the four
    quarters of each (path, hash) digest: order-free, and one small state per task
    however many files there are.
    """
    digest = F.sha2(F.concat_ws("|", "path", "sha256"), 256)
    quarters = [
        F.sum(F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(38,0)")).alias(f"_q{i}")
        for i in range(4)
    ]
    total = fingerprints.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("size"),
        F.max("sha256").alias("_only"),
        *quarters,
    )
    many = F.sha2(F.concat_ws("|", *[F.col(f"_q{i}").cast("string") for i in range(4)]), 256)
    return total.select(
        F.when(F.col("file_count") == 1, F.col("_only")).when(F.col("file_count") > 1, many).alias("sha256"),
        "file_count",
        "size",
    )


def source_changes(current: DataFrame, last: DataFrame, full_reload: bool = False) -> DataFrame:
    """Per file, its hash now, the hash last published, and whether it must be read again.

    A file with no known last hash counts as changed; ``full_reload`` makes all count.
    """
    known = last.select("path", F.col("sha256").alias("last_sha256"))
    changed = F.col("last_sha256").isNull() | (F.col("last_sha256") != F.col("sha256"))
    return current.join(known, "path", "left").select(
        "path",
        "sha256",
        "last_sha256",
        (changed | F.lit(full_reload)).alias("changed"),
    )


def file_reads(
    changes: DataFrame, reads: DataFrame, how: str, since: datetime | None, version: str
) -> DataFrame:
    """``(path, how, since, read_version)`` of the files of a run: those with ``read_version``
    equal to ``version`` are to be read, the others keep their entry in ``reads``.

    A file need not be read again if its content is the same, it was read in the same way
    (``how``), and for all rows that are wanted now: all of them, or those after a time that is
    not later than ``since``. What it can give was published then or is known since.
    """
    cutoff = F.lit(since.isoformat(sep=" ") if since else None).cast("timestamp_ntz")
    last = reads.select("path", *[F.col(c).alias(f"_last_{c}") for c in ("how", "since", "read_version")])
    covers = F.col("_last_since").isNull() | (F.col("_last_since") <= cutoff)
    same = F.coalesce(~F.col("changed") & (F.col("_last_how") == how) & covers, F.lit(False))
    return changes.join(last, "path", "left").select(
        "path",
        F.lit(how).alias("how"),
        F.when(same, F.col("_last_since")).otherwise(cutoff).alias("since"),
        F.when(same, F.col("_last_read_version")).otherwise(F.lit(version)).alias("read_version"),
    )
