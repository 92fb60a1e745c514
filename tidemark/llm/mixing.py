"""Mixing sources to target weights along a curriculum that changes over training time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import word_count, written

# Weights of the sources in code point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)

# Knots (training time, rate) of each weight's schedule, linear between them, repeating
# with the weights: lighter sources fade, heavier ones ramp up.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 1.25), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
)

# A document of a source and hash prefix lies in one of so many slices of the source, so no
# source, however large, is ordered by one task.
PREFIX_DIGITS = 3


def source_targets(
    sizes: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    limit: float = 3.0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Targets of the sources, from rows ``source``, ``source_size`` (one per source).

    Adds ``rank`` (place in code point order from 0, null last), ``weight`` and ``target``.
    The targets share the total of all sizes by weight. None exceeds ``limit`` times its
    source's size; what it would exceed is shared by weight among the others. In order of
    ``limit * size / weight`` the stopped sources come first, so one running sum finds them.
    There is one row per source here, and no document. Columns named in ``carry`` are kept.
    """
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn(
        "weight",
        F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int")),
    )
    everyone = Window.partitionBy()
    before = Window.orderBy("ceiling", "rank").rowsBetween(Window.unboundedPreceding, -1)
    capped = ranked.select(
        "*",
        (F.lit(float(limit)) * F.col("source_size") / F.col("weight")).alias("ceiling"),
        F.sum("source_size").over(everyone).alias("total"),
        F.sum("weight").over(everyone).alias("all_weights"),
    ).select(
        "*",
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("sizes_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
    )
    level = (F.col("total") - F.lit(float(limit)) * F.col("sizes_before")) / (
        F.col("all_weights") - F.col("weights_before")
    )
    settled = capped.withColumn("level", level).withColumn("stopped", F.col("level") > F.col("ceiling"))
    # The level at the first source that is not stopped holds for all that follow.
    level_kept = F.first(F.when(~F.col("stopped"), F.col("level")), ignorenulls=True).over(
        Window.orderBy("ceiling", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("stopped"), F.lit(float(limit)) * F.col("source_size")).otherwise(
        level_kept * F.col("weight")
    )
    return settled.select(*carry, "source", "source_size", "rank", "weight", target.alias("target"))


def segments(schedule: Sequence[tuple[float, float]]) -> list[tuple[float, ...]]:
    """The pieces of a schedule as (start, end, rate at start, slope, share before, share
    after), the rates scaled so that the whole schedule integrates to 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))
    if schedule[0][0] != 0.0 or schedule[-1][0] != 1.0 or area <= 0 or min(w for _, w in schedule) < 0:
        raise ValueError("a schedule runs from time 0 to 1 with rates of at least 0, not all 0")
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        share = (t1 - t0) * (w0 + w1) / 2 / area
        out.append((t0, t1, w0 / area, (w1 - w0) / area / (t1 - t0), done, done + share))
        done += share
    out[-1] = (*out[-1][:5], 1.0)
    return out


def _time_at(share: Column, rank: Column, schedules: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """Training time at which a source has spent a share of its target."""
    names = ("start", "end", "rate", "slope", "before", "after")
    literal = F.array(
        *(
            F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, piece))) for piece in segments(schedule)))
            for schedule in schedules
        )
    )
    pieces = F.element_at(literal, (rank % len(schedules) + 1).cast("int"))
    piece = F.element_at(F.filter(pieces, lambda s: share <= s["after"]), 1)
    spent = share - piece["before"]
    root = piece["rate"] + F.sqrt(F.greatest(piece["rate"] * piece["rate"] + 2.0 * piece["slope"] * spent, F.lit(0.0)))
    return piece["start"] + F.coalesce(2.0 * spent / F.nullif(root, F.lit(0.0)), F.lit(0.0))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    limit: float = 3.0,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (words), ``source_size``, ``target``,
    ``copies``, ``taken`` (words times copies), ``positions`` (training times of the copies,
    rising), ``content`` (hash of the text).

    Each source spends its target along its schedule, pass after pass over its documents in
    the order of the MD5 of their ids. A copy stands at the time at which the cumulative
    demand reaches the middle of the document. A last, partial pass takes the documents of
    which at least half lies before its end, so a source misses its target by at most half a
    document. ``copies`` never exceeds ``limit`` rounded up.

    A null text has size 0; a document of size 0 is taken as often as its place says and
    adds no words. A null source is a source. Null ids come first in their source; rows equal
    in id follow by size, then hash. An empty table gives an empty one. Other columns are not read.

    Every source is ordered in slices by the first digits of the MD5, with one running sum
    over the slices and one inside each, so a source may hold any part of all rows.
    """
    key = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    rows = written(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`")), F.lit("")).alias("source_key"),
            word_count(F.col(f"`{text_col}`")).alias("size"),
            key.alias("place"),
            F.substring(key, 1, PREFIX_DIGITS).alias("slice"),
            F.xxhash64(f"`{text_col}`").alias("content"),
        )
    )
    slices = rows.groupBy("source_key", "source", "slice").agg(F.sum("size").alias("slice_size"))
    targets = source_targets(
        slices.groupBy("source_key", "source").agg(F.sum("slice_size").alias("source_size")),
        weights=weights,
        limit=limit,
        carry=("source_key",),
    )
    earlier = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slices.select(
            "source_key", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("slice_start")
        )
        .join(targets.drop("source", "weight"), "source_key")
    )
    inside = (
        Window.partitionBy("source_key", "slice")
        .orderBy("place", "id", "size", "content")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.drop("source").join(starts, ["source_key", "slice"]).withColumn(
        "middle",
        F.col("slice_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / F.lit(2.0),
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    partial = F.col("middle") <= F.col("target") - F.col("passes") * F.col("source_size")
    share = lambda number: F.when(
        F.col("target") > 0,
        F.least((number * F.col("source_size") + F.col("middle")) / F.col("target"), F.lit(1.0)),
    ).otherwise(0.0)
    return (
        placed.withColumn("passes", passes.cast("bigint"))
        .withColumn("copies", F.col("passes") + F.when(partial, 1).otherwise(0))
        .select(
            F.col("id").alias(id_col),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
            F.transform(
                F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).otherwise(
                    F.array().cast("array<bigint>")
                ),
                lambda number: _time_at(share(number), F.col("rank"), schedules),
            ).alias("positions"),
            "content",
        )
    )


def training_order(mixed: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The copies of a mix in the order in which training meets them: id, ``copy``,
    ``position``, range-partitioned and sorted by position, then id and copy."""
    return (
        mixed.select(F.col(f"`{id_col}`"), F.posexplode("positions").alias("copy", "position"))
        .repartitionByRange("position", F.col(f"`{id_col}`"), "copy")
        .sortWithinPartitions("position", F.col(f"`{id_col}`"), "copy")
    )


def take(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options: object,
) -> DataFrame:
    """The rows of ``docs``, all columns, each as many times as the mix takes it, in the order
    of training: range-partitioned and sorted by the position of the copy, then id and copy.
    Rows equal in id and text share the largest of their numbers of copies, and its positions."""
    mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    key = lambda id_value, content: F.struct(id_value.alias("id"), content.alias("content"))
    copies = (
        mixed.where("copies > 0")
        .groupBy(key(F.col(f"`{id_col}`"), F.col("content")).alias("key"))
        .agg(F.max(F.struct("copies", "positions")).alias("most"))
        .select("key", "most.positions")
    )
    row = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row"),
        key(F.col(f"`{id_col}`"), F.xxhash64(f"`{text_col}`")).alias("key"),
    )
    return (
        row.join(copies, "key")
        .select("row", F.col("key.id").alias("id"), F.posexplode("positions").alias("copy", "position"))
        .repartitionByRange("position", "id", "copy")
        .sortWithinPartitions("position", "id", "copy")
        .select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
    )
