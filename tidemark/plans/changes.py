"""Published versions as a feed of change notices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import NOTICE_TYPE, manifest_pointer, text_sha256


def change_feed(manifests: DataFrame, since_version: str | None = None) -> DataFrame:
    """One notice per version later than ``since_version``.

    ``group_id`` and ``deduplication_id`` are what an ordered topic needs; delivering
    the notices is left to a streaming or batch sink.
    """
    if since_version is not None:
        manifests = manifests.where(F.col("version") > since_version)
    pointer = manifest_pointer(F.col("dataset_id"), F.col("version"))
    return manifests.select(
        F.lit(NOTICE_TYPE).alias("type"),
        F.col("created_at").alias("timestamp"),
        "dataset_id",
        "version",
        pointer.alias("manifest_pointer"),
        F.col("dataset_id").alias("group_id"),
        text_sha256(pointer).alias("deduplication_id"),
    )
