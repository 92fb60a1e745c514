"""Does the key index agree with the published manifest?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How many rows index and manifest may differ by default: both are exact counts.
ROW_TOLERANCE = 0


def consistency_report(
    pointer: DataFrame,
    manifests: DataFrame,
    index: DataFrame,
    tolerance: int = ROW_TOLERANCE,
    expected_rows: int | None = None,
) -> DataFrame:
    """One row ``(consistent, expected, actual, reason)``.

    ``pointer`` holds at most one row ``(dataset_id, current_version)``. The index is
    only counted; a count needs no column, so Parquet footers answer it. ``expected_rows``
    stands for the count of the current manifest, where a rebuild has corrected it.
    """
    named = pointer.select(F.col("current_version").alias("version"))
    published = manifests.join(named, "version", "left_semi").agg(
        F.count(F.lit(1)).alias("rows"), F.max("outputs.rows_total" if expected_rows is None else F.lit(expected_rows)).alias("expected")
    )
    one = pointer.agg(
        F.count(F.lit(1)).alias("_pointers"), F.max("current_version").alias("_current")
    ).select(
        "*",
        published.select("rows").scalar().alias("_manifests"),
        published.select("expected").scalar().alias("expected"),
        index.agg(F.count(F.lit(1))).scalar().alias("actual"),
    )
    reason = (
        F.when((F.col("_pointers") == 0) & (F.col("actual") == 0), "nothing published")
        .when(F.col("_pointers") == 0, "index without a published version")
        .when(F.col("_current").isNull(), "pointer names no version")
        .when(F.col("_manifests") == 0, "manifest missing")
        .when(F.col("actual") == 0, "index missing")
        .when(F.col("expected").isNull(), "manifest has no row count")
        .when(F.abs(F.col("actual") - F.col("expected")) <= tolerance, "within tolerance")
        .otherwise("row counts differ")
    )
    agreed = ("nothing published", "manifest has no row count", "within tolerance")
    return one.withColumn("reason", reason).select(
        F.col("reason").isin(*agreed).alias("consistent"), "expected", "actual", "reason"
    )
