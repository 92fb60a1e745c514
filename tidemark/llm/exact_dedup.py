"""Exact deduplication by content hash, with the bytes compared inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import without_spaces


def content_digest(content: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(content))


def duplicate_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = without_spaces,
    digest: Callable[[Column], Column] = content_digest,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are grouped by the digest of their normalised text and, within a digest, by the
    text itself, so texts that merely share a digest stay apart. Of a group the row with
    the most code points stays, then the one with the smallest id (null ids last).

    A null text counts as empty, so all empty, blank and null texts form one group. A row
    that repeats another, id included, gets a row of its own here and counts in
    ``group_size``; ``deduplicate`` keeps one of them. An empty table gives an empty one.
    Only the id and text columns are read, so further columns may have any name.

    The grouping is combined before its shuffle: a group of any size sends one text per
    task. The rows themselves are matched to their group by two hashes, without text.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    content = normalise(text)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.length(text).cast("bigint").alias("points"),
        content.alias("content"),
    ).withColumn("digest", digest(F.col("content")))
    # Points and id of the best row order as one value.
    rank = F.struct((-F.col("points")).alias("fewer"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    groups = (
        rows.groupBy("digest", "content")
        .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "digest",
            F.sha2("content", 256).alias("text_sha256"),
            F.col("best.id").alias("keep_id"),
            (-F.col("best.fewer")).alias("keep_points"),
            "group_size",
        )
    )
    members = rows.select("id", "points", "digest", F.sha2("content", 256).alias("text_sha256"))
    return members.join(groups, ["digest", "text_sha256"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
        "text_sha256",
    )


def deduplicate(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = without_spaces,
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; of rows that repeat a kept row in id and
    normalised text, one with the most code points stays (which one is open if they differ
    elsewhere). Columns keep their names, whatever they are."""
    kept = (
        duplicate_classes(docs, id_col=id_col, text_col=text_col, normalise=normalise)
        .where("kept")
        .select(F.struct(F.col(f"`{id_col}`").alias("id"), F.col("text_sha256").alias("sha")).alias("key"))
        .distinct()
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    row = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row"),
        F.struct(F.col(f"`{id_col}`").alias("id"), F.sha2(normalise(text), 256).alias("sha")).alias("key"),
        F.length(text).alias("points"),
    )
    return (
        row.join(kept, "key", "left_semi")
        .groupBy("key")
        .agg(F.max_by("row", "points").alias("row"))
        .select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
    )
