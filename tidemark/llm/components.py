"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder, written
from tidemark.sources.paths import remove_path


def _large_star(links: DataFrame) -> DataFrame:
    """Joins every larger neighbour of a node to the smallest node around it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the smallest of them. Links have a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    lower = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return lower.union(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """Rows ``node``, ``root`` (smallest node of its component) for each node that is larger
    than its root, from links with the numeric ends ``a`` and ``b``, nulls apart.

    Alternating star rounds: each shortens the paths to the smallest node, and a round that
    changes nothing ends them, after a number of rounds that grows with the logarithm of the
    longest path. Each round is a table below ``folder``; the one before it is removed.
    Minima are combined before their shuffle, so a node with many links costs one row a task.
    """
    spark = links.sparkSession
    folder = folder or shared_folder(spark)

    def state(rows: DataFrame) -> tuple[object, ...]:
        return tuple(
            rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    kept = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    number, rows = 0, written(kept, f"{folder}/0")
    before = state(rows)
    while True:
        number += 1
        rows = written(_small_star(_large_star(rows)), f"{folder}/{number}")
        now = state(rows)
        remove_path(spark, f"{folder}/{number - 1}")
        if now == before:
            return rows.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
