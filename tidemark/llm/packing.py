"""Conflict-constrained best-fit packing of documents into training sequences."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import without_spaces, word_count, written

# Words a bin holds, most documents of one source in a bin, pieces packed by one task.
CAPACITY = 2048
PER_SOURCE = 4
SHARD_ROWS = 20_000


class Shelf:
    """Open bins by free space. Bins alike in free space and in bitmaps lie in one stack, so a
    search passes over all of them at once where a document does not go with them."""

    def __init__(self) -> None:
        self.residuals: list[int] = []  # sorted, those with a bin
        self.stacks: dict[int, dict[tuple[tuple[int, ...], int], list[int]]] = {}

    def put(self, residual: int, sources: tuple[int, ...], clusters: int, number: int) -> None:
        if residual not in self.stacks:
            insort(self.residuals, residual)
            self.stacks[residual] = {}
        self.stacks[residual].setdefault((sources, clusters), []).append(number)

    def pull(self, size: int, source: int, cluster: int) -> tuple[int, tuple[int, ...], int, int] | None:
        """Removes and returns the tightest bin that has ``size`` free, room for one more of
        the source (its last bitmap lacks the bit) and nothing of the cluster: the latest of
        the first stack that goes with the document."""
        for at in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[at]
            stacks = self.stacks[residual]
            for (sources, clusters), bins in stacks.items():
                if not (sources[-1] & source or clusters & cluster):
                    number = bins.pop()
                    if not bins:
                        del stacks[sources, clusters]
                        if not stacks:
                            del self.stacks[residual], self.residuals[at]
                    return residual, sources, clusters, number
        return None


def pack_shard(
    sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int
) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, placed in the given order.

    ``sources`` and ``clusters`` are bit numbers; cluster -1 conflicts with nothing. A bin
    carries ``per_source`` source bitmaps, the k-th with the sources of which it holds k
    documents, and one bitmap of clusters.
    """
    shelf, opened = Shelf(), 0
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        source_bit, cluster_bit = 1 << source, (1 << cluster if cluster >= 0 else 0)
        found = shelf.pull(size, source_bit, cluster_bit) if size < capacity else None
        if found is None:
            residual, maps, seen, number = capacity, (0,) * per_source, 0, opened
            opened += 1
        else:
            residual, maps, seen, number = found
        bins.append(number)
        offsets.append(capacity - residual)
        level = next(i for i, m in enumerate(maps) if not m & source_bit)
        maps = (*maps[:level], maps[level] | source_bit, *maps[level + 1 :])
        if residual > size:
            shelf.put(residual - size, maps, seen | cluster_bit, number)
    return bins, offsets


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece of each row of ``docs``: id, ``copy``, ``piece``, ``first_word``,
    ``n_words``, ``cluster``, ``bin_id``, ``bin_offset``.

    Documents longer than ``capacity`` words are cut into full pieces, each a bin of its own,
    and a rest. Rests and shorter documents go, the longest first, into the tightest bin that
    has room, fewer than ``per_source`` documents of the source, and none of the same
    duplicate cluster (texts equal but for white space); a bin is opened where there is none.

    The work is dealt by a hash into shards of about ``shard_rows`` pieces, each packed by one
    task with bins of its own, so bins left open are at most a few per shard. Sources and
    clusters are spread over all shards, whatever part of the rows they hold.

    Rows alike in id, source and text are told apart by ``copy``, from 1, and are one cluster.
    A null or blank text has one row without words and a null bin. Null sources are a source
    of their own. An empty table gives an empty one. Other columns are not read.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        F.xxhash64(without_spaces(F.col(f"`{text_col}`"))).alias("cluster"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )
    copies = rows.groupBy("id", "source", "cluster", "size").agg(F.count(F.lit(1)).alias("times"))
    pieces = copies.select(
        "id", "source", "cluster", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("copy")
    ).select(
        "*",
        F.explode(
            F.sequence(
                F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("size") / F.lit(capacity)) - 1, F.lit(0)).cast("bigint")
            )
        ).alias("piece"),
    )
    pieces = written(
        pieces.withColumn("first_word", F.col("piece") * capacity)
        .withColumn("n_words", F.least(F.col("size") - F.col("first_word"), F.lit(capacity)))
        .withColumn("place", F.xxhash64("id", "cluster", "copy", "piece"))
        .drop("size")
    )
    shards = max(1, -(-pieces.count() // shard_rows))

    def run(shard: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("place", "id", "copy", "piece")]
        shard = shard.sort_by([("n_words", "descending"), *order])
        clusters = shard["cluster"].to_pylist()
        counts = Counter(clusters)
        bits: dict[int, int] = {}
        sources: dict[object, int] = {}
        bins, offsets = pack_shard(
            shard["n_words"].to_pylist(),
            [sources.setdefault(v, len(sources)) for v in shard["source"].to_pylist()],
            [bits.setdefault(v, len(bits)) if counts[v] > 1 else -1 for v in clusters],
            capacity,
            per_source,
        )
        first_bin = shard["shard"][0].as_py() << 32
        shard = shard.append_column("bin_id", pa.array([first_bin + b for b in bins], pa.int64()))
        return shard.append_column("bin_offset", pa.array(offsets, pa.int64())).select(schema.names)

    kept = ["id", "copy", "piece", "first_word", "n_words", "cluster"]
    schema = T.StructType(
        [pieces.schema[name] for name in kept]
        + [T.StructField("bin_id", T.LongType()), T.StructField("bin_offset", T.LongType())]
    )
    packed = (
        pieces.where("n_words > 0")
        .withColumn("shard", F.pmod(F.col("place"), F.lit(shards)).cast("bigint"))
        .groupBy("shard")
        .applyInArrow(run, schema)
    )
    blank = pieces.where("n_words = 0").select(
        *kept, F.lit(None).cast("bigint").alias("bin_id"), F.lit(None).cast("bigint").alias("bin_offset")
    )
    return packed.union(blank).withColumnRenamed("id", id_col)
