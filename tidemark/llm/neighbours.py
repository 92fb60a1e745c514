"""Nearest neighbours by cosine: a forest of random-projection trees, one queue per query."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch

NEAREST = 5
# Trees, and the different vectors that their planes are fitted on, at most. The forest is
# what the driver holds and each task gets: at most TREES * SAMPLE planes.
TREES = 4
SAMPLE = 8192
# A node of so few sampled vectors is a leaf.
LEAF = 32
# A search ends when the leaves it has opened in all trees hold this share of the sample. It
# is a share, so what is found does not depend on the size of the table. Trees over few
# vectors have few planes to tell near from far, so it opens leaves of LEAST at any rate.
REACH = 0.9
LEAST = 4096
# Vectors multiplied at once.
BLOCK = 1024
SEED = 20


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in arrays. A leaf has no plane, and a number >= 0."""

    planes: np.ndarray
    offsets: np.ndarray
    below: np.ndarray
    above: np.ndarray
    leaf: np.ndarray
    mass: np.ndarray
    roots: tuple[int, ...]
    sampled: int

    def leaves_of(self, unit: np.ndarray) -> np.ndarray:
        """Per vector its leaf in each tree."""
        out = np.empty((len(unit), len(self.roots)), np.int32)
        for tree, root in enumerate(self.roots):
            open_nodes = [(root, np.arange(len(unit)))]
            while open_nodes:
                at, rows = open_nodes.pop()
                if self.leaf[at] >= 0:
                    out[rows, tree] = self.leaf[at]
                elif len(rows):
                    up = unit[rows] @ self.planes[at] >= self.offsets[at]
                    open_nodes += [(self.below[at], rows[~up]), (self.above[at], rows[up])]
        return out

    def search(self, unit: np.ndarray, reach: float, least: int = LEAST) -> list[np.ndarray]:
        """Per vector the leaves to look into. All trees share one queue, ordered by how far
        the vector lies on the other side of the farthest plane passed; the nearest node is
        followed down to its leaf, and what is left aside on the way is queued."""
        margins = unit @ self.planes.T - self.offsets
        below, above, leaf, mass = (x.tolist() for x in (self.below, self.above, self.leaf, self.mass))
        wanted = max(reach * self.sampled, least)
        found = []
        for row in margins:
            margin, held, leaves = row.tolist(), 0, []
            # The leaf the vector itself is in comes first in every tree.
            queue = [(-1.0, root) for root in self.roots]
            while queue and (held < wanted or queue[0][0] < 0):
                bound, at = heapq.heappop(queue)
                while leaf[at] < 0:
                    d = margin[at]
                    near, far = (above[at], below[at]) if d >= 0 else (below[at], above[at])
                    heapq.heappush(queue, (max(bound, abs(d)), far))
                    at = near
                leaves.append(leaf[at])
                held += mass[at]
            found.append(np.array(leaves, np.int32))
        return found


def fit_forest(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED) -> Forest:
    """Trees over unit vectors. A plane stands halfway between two random vectors of a node
    and is moved to the median, so both sides get half of the sample."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    numbers = 0

    def grow(rows: np.ndarray) -> int:
        nonlocal numbers
        at = len(nodes)
        nodes.append([np.zeros(sample.shape[1]), 0.0, -1, -1, -1, len(rows)])
        if len(rows) > leaf:
            a, b = rng.choice(rows, 2, replace=False)
            plane = sample[a] - sample[b]
            length = np.linalg.norm(plane)
            if length > 0:
                plane = plane / length
                cast = sample[rows] @ plane
                offset = float(np.median(cast))
                up = cast >= offset
                if up.any() and not up.all():
                    nodes[at][:4] = plane, offset, grow(rows[~up]), grow(rows[up])
                    return at
        nodes[at][4], numbers = numbers, numbers + 1
        return at

    roots = tuple(grow(np.arange(len(sample))) for _ in range(trees)) if len(sample) else ()
    planes, *rest = zip(*nodes) if nodes else ((), (), (), (), (), ())
    offsets, below, above, number, mass = (np.array(x) for x in rest)
    return Forest(
        np.array(planes).reshape(len(nodes), sample.shape[1]), offsets, below, above, number, mass, roots, len(sample)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that neither tiny nor huge components leave the range of doubles.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classes(rows: DataFrame, kept: int) -> DataFrame:
    """Per different vector its ``kept`` smallest ids, a row of equal id counting anew. Only
    they can be among the nearest, so a vector that very many rows share is one candidate;
    tasks keep no more of it before the shuffle."""
    first = Window.partitionBy("vector").orderBy("id")
    return (
        rows.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= kept)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.xxhash64("vector").alias("hash"), "vector", "ids")
        .withColumn("class", F.struct("hash", F.get("ids", 0).alias("least")))
    )


def usable(vector: str, dimension: int) -> object:
    """Whether a vector takes part: of the dimension, all components finite, not all zero."""
    component = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        (F.size(vector) == dimension) & F.forall(vector, component) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _packed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (leaf, number, vector) as blocks: per leaf the numbers and the vectors of at most
    ``BLOCK`` rows. ``rows`` lie together by leaf within their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(batch: pa.RecordBatch) -> pa.RecordBatch:
            offsets = pa.array([0, batch.num_rows], pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column(0)[:1], *(pa.ListArray.from_arrays(offsets, batch.column(i)) for i in range(1, batch.num_columns - 1))]
                + [pa.array([_matrix(batch.column(batch.num_columns - 1)).tobytes()], pa.binary())],
                names=["leaf", *columns],
            )

        def joined() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(leaves)) + 1).tolist(), len(leaves)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and held[0].column(0)[0].as_py() != leaves[a]:
                    yield block(joined())
                    held = []
                while a < b:
                    room = BLOCK - sum(h.num_rows for h in held)
                    part = batch.slice(a, min(room, b - a))
                    held.append(part)
                    a += part.num_rows
                    if part.num_rows == room:
                        yield block(joined())
                        held = []
        if held:
            yield block(joined())

    fields = [rows.schema["leaf"]]
    for name, field in zip(columns[:-1], rows.schema.fields[1:-1]):
        fields.append(T.StructField(name, T.ArrayType(field.dataType)))
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField(columns[-1], T.BinaryType())]))


def _sample(classes: DataFrame, size: int) -> np.ndarray:
    rows = classes.orderBy("hash", "vector").limit(size).select("vector").collect()
    return _unit(np.array([r.vector for r in rows], np.float64)) if rows else np.empty((0, 1))


def nearest(
    vectors: DataFrame,
    queries: object,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    reach: float = REACH,
    seed: int = SEED,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the id and ``score`` (cosine in doubles) of the ``k``
    nearest rows found for each row that fulfils the condition ``queries``, itself left out;
    equal scores by the smaller id, fewer rows if there are fewer.

    Vectors that are null, zero, hold a null or a component that is not finite, or have not
    the dimension that most rows have, take no part; so do rows with a null id. Repeated rows
    are rows of their own. Columns beside id and vector are not read, and only ``queries`` sees
    them. An empty table gives an empty one.

    1. Rows of equal vectors become a class with its smallest ids, queries likewise.
    2. A forest is fitted on at most ``sample`` classes, the first by hash, and every class is
       put into one leaf of each tree.
    3. Each different query vector searches all trees through one queue.
    4. Leaves meet in a join, of blocks on both sides; products of blocks give the exact
       cosines of all their pairs, of which the best ``k + 1`` a query and block go on.
    5. The best classes of a query are merged and give back their ids.
    """
    scratch = Scratch(vectors.sparkSession)
    named = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")
    ).where("id is not null")
    sizes = named.where(F.size("vector") > 0).groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    dimension = (sizes.orderBy(F.desc("rows"), F.desc("size")).first() or Row(size=1, rows=0))["size"]
    rows = named.where(usable("vector", dimension))
    classes = scratch.table(_classes(rows.select("id", "vector"), k + 1))
    fitted = _sample(classes, sample)
    forest = fit_forest(fitted, trees, leaf, seed)
    shared = vectors.sparkSession.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                leaves = shared.value.leaves_of(_unit(_matrix(part.column(1))))
                owner = pa.array(np.repeat(np.arange(part.num_rows), leaves.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaves.reshape(-1)), part.column(0).take(owner), part.column(1).take(owner)],
                    names=["leaf", "class", "vector"],
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK // 4):
                part = batch.slice(at, BLOCK // 4)
                found = shared.value.search(_unit(_matrix(part.column(1))), reach)
                owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), part.column(0).take(owner), part.column(1).take(owner)],
                    names=["leaf", "class", "vector"],
                )

    leaves = max(1, int((forest.leaf >= 0).sum()))
    opened = max(reach * forest.sampled, LEAST) * leaves / max(1, trees * forest.sampled)

    def in_leaves(source: DataFrame, step: object, times: float) -> DataFrame:
        fields = [T.StructField("leaf", T.IntegerType()), source.schema["class"], source.schema["vector"]]
        placed = source.select("class", "vector").mapInArrow(step, T.StructType(fields))
        # Leaves of more than a block of rows, each vector being in ``times``, are dealt to
        # several tasks; small ones stay whole, so that a block has few best rows to pass on.
        parts = ceil(source.count() * min(times, leaves) / leaves / BLOCK)
        part = F.pmod(F.xxhash64("class"), F.lit(max(1, parts)))
        return placed.repartition("leaf", part).sortWithinPartitions("leaf")

    asking = scratch.table(_classes(rows.where("asks").select("id", "vector"), 1).select("hash", "vector", "class"))
    candidates = scratch.table(_packed(in_leaves(classes, place, trees), ["classes", "vectors"]))
    asked = scratch.table(_packed(in_leaves(asking, ask, opened), ["askers", "queries"]))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                askers, classes_of = batch.column(0)[i].values, batch.column(2)[i].values
                left, right = (
                    _unit(np.frombuffer(batch.column(c)[i].as_py(), np.float64).reshape(n, -1))
                    for c, n in ((1, len(askers)), (3, len(classes_of)))
                )
                score = left @ right.T
                best = min(k + 1, score.shape[1])
                # Of equal scores the class with the smallest id.
                by_id = np.argsort(classes_of.field("least").to_numpy(zero_copy_only=False), kind="stable")
                top = by_id[np.argsort(-score[:, by_id], axis=1, kind="stable")[:, :best]]
                yield pa.RecordBatch.from_arrays(
                    [
                        askers.take(pa.array(np.repeat(np.arange(len(askers)), best))),
                        classes_of.take(pa.array(top.reshape(-1))),
                        pa.array(np.take_along_axis(score, top, axis=1).reshape(-1)),
                    ],
                    names=["asker", "class", "score"],
                )

    kind = classes.schema["class"].dataType
    fields = [T.StructField("asker", kind), T.StructField("class", kind), T.StructField("score", T.DoubleType())]
    met = asked.join(candidates, "leaf").select("askers", "queries", "classes", "vectors")
    pairs = met.mapInArrow(multiply, T.StructType(fields)).groupBy("asker", "class").agg(F.max("score").alias("score"))
    best_first = Window.partitionBy("asker").orderBy(F.desc("score"), "class.least")
    best = pairs.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k + 1).drop("place")
    best = scratch.table(best)
    members = best.join(classes.select("class", "ids"), "class").select("asker", "score", F.explode("ids").alias("id"))
    near = members.groupBy("asker").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))), 1, k + 1).alias("near")
    )
    near = scratch.table(near.join(asking.select(F.col("class").alias("asker"), F.col("vector").alias("shared")), "asker"))
    asks = rows.where("asks").select(F.col("id").alias("query_id"), "vector")
    answered = asks.join(near, F.col("vector") == F.col("shared"))
    own = F.array_position(F.transform("near", lambda x: x["id"]), F.col("query_id"))
    others = F.filter(F.col("near"), lambda x, i: i + 1 != own)
    result = answered.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias(id_col), (-F.col("hit.far")).alias("score")
    )
    scratch.keep_only(near)
    return result
