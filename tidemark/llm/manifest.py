"""Merkle manifest of a dataset: stored levels, proofs by recomputation, verification."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import shared_folder, written
from tidemark.sources.paths import remove_path

# Children of a node, and how many levels lie between two that are stored.
ARITY = 8
STRIDE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:string,right:string>>"


def hash_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return hash_of(*(field(v) for v in values))


def _depth(n: Column, arity: int) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves; a lone leaf is its own root."""
    height, levels, reached = F.lit(0), 0, 1
    while reached < 2**62:
        height = height + (n > reached).cast("int")
        levels, reached = levels + 1, reached * arity
    return height


def _ordered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in the group, and ``n``, its size.

    Rows are dealt by ranges of (group, order), so a group of any size is spread, and counted
    within their partition; small tables of counts give the offsets. ``tie`` makes every key
    differ, so equal rows do not fall into one range either."""
    source = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "tie")]
    dealt = source.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    at = dealt.columns.index(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(at)
            same = pc.fill_null(pc.equal(values[1:], values[:-1]), False) if batch.num_rows > 1 else pa.array([], pa.bool_())
            blank = pc.and_(pc.is_null(values[1:]), pc.is_null(values[:-1])) if batch.num_rows > 1 else same
            starts = np.flatnonzero(~np.concatenate(([False], pc.or_(same, blank).to_numpy(zero_copy_only=False))))
            places = np.arange(batch.num_rows)
            within = places - np.repeat(starts, np.diff(np.append(starts, batch.num_rows)))
            if last is not None and last[0] == values[0].as_py():
                first = starts[1] if len(starts) > 1 else batch.num_rows
                within[:first] += seen
            last, seen = (values[-1].as_py(),), int(within[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(within)],
                names=[*batch.schema.names, "part", "within"],
            )

    schema = T.StructType([*dealt.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("within", T.LongType())])
    numbered = written(dealt.mapInArrow(number, schema))
    counts = numbered.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        counts.select(
            F.col(group).alias("of"),
            F.col("part").alias("in_part"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
            F.sum("rows").over(whole).alias("n"),
        )
    )
    return (
        numbered.join(offsets, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
        .withColumn("pos", F.col("within") + F.col("offset"))
        .drop("of", "part", "in_part", "within", "offset")
    )


def _up(nodes: Column, arity: int) -> Column:
    """The next level over the nodes of an aligned subtree."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / F.lit(arity)).cast("int"))
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(nodes, r * arity + 1, F.lit(arity)), ""), 256))


def _blocks(nodes: DataFrame, group: str, level: int, arity: int, stride: int, payload: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree of ``arity ** stride`` nodes: group, ``n``, ``height`` of
    the tree, ``block``, ``nodes`` in order."""
    width = arity**stride
    return (
        nodes.withColumn("block", F.floor(F.col("pos") / width))
        .groupBy(group, "block")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "hash", *payload))).alias("nodes"))
        .withColumn("height", F.greatest(F.lit(0), F.least(F.lit(stride), _depth(F.col("n"), arity) - F.lit(level))))
    )


def build(
    rows: DataFrame, group: str, order: Sequence[str], arity: int = ARITY, stride: int = STRIDE, folder: str | None = None
) -> list[DataFrame]:
    """The stored levels of one tree per group over the column ``hash``: level 0 (all columns
    of ``rows``, ``pos`` and ``n``), then every ``stride``-th, the last with the roots of the
    largest trees. Each is a table below ``folder``, so nothing is computed twice and a lost
    executor costs a read. Nodes in between are hashed inside an aligned subtree, not kept."""
    folder = folder or shared_folder(rows.sparkSession)
    levels = [written(_ordered(rows, group, order), f"{folder}/level=0")]
    largest = levels[0].agg(F.max("n")).first()[0] or 0
    height, reached = 0, 1
    while reached < largest:
        height, reached = height + 1, reached * arity
    for level in range(0, height, stride):
        blocks = _blocks(levels[-1], group, level, arity, stride).where("height > 0")
        nodes = F.col("nodes.hash")
        for step in range(stride):
            nodes = F.when(F.col("height") > step, _up(nodes, arity)).otherwise(nodes)
        stored = blocks.select(group, F.col("block").alias("pos"), "n", F.get(nodes, 0).alias("hash"))
        levels.append(written(stored, f"{folder}/level={level + stride}"))
    return levels


def _stored_above(n: Column, arity: int, stride: int) -> Column:
    """How many stored levels a tree has above its leaves; the last holds its root."""
    return F.ceil(_depth(n, arity) / stride).cast("int")


def roots(levels: list[DataFrame], group: str, arity: int = ARITY, stride: int = STRIDE) -> DataFrame:
    """``group`` and ``hash``: the node that each tree ends in."""
    tops = [t.where(_stored_above(F.col("n"), arity, stride) == k).select(group, "hash") for k, t in enumerate(levels)]
    return reduce(DataFrame.union, tops)


def _sides(nodes: Column, index: Column, arity: int) -> Column:
    """The others of a node's run, to its left and to its right."""
    start = F.floor(index / arity).cast("int") * arity
    return F.struct(
        F.array_join(F.slice(nodes, start + 1, index - start), "").alias("left"),
        F.array_join(F.slice(nodes, index + 2, start + F.lit(arity - 1) - index), "").alias("right"),
    )


def prove(levels: list[DataFrame], group: str, above: DataFrame, arity: int = ARITY, stride: int = STRIDE) -> DataFrame:
    """Level 0 with ``steps`` for each row: the left and the right siblings of each level from
    the leaf to the root, then the ``steps`` that ``above`` has for the group, and the other
    columns of ``above`` (one row per group).

    From the top down, each stored level is cut into aligned subtrees. The nodes missing in
    one are hashed anew from its stored ones, give their siblings, and go with the row. What
    lies above is joined once per subtree, so no key has more than ``arity ** stride`` rows,
    however large a group is."""
    extra = [c for c in above.columns if c not in (group, "steps")]
    payload = [c for c in levels[0].columns if c not in (group, "pos", "n", "hash")]
    top = F.greatest(F.lit(0), _stored_above(F.col("n"), arity, stride) - 1)
    heads = levels[0].where("pos = 0").select(F.col(group).alias("of"), top.alias("top"))
    starts = written(
        heads.join(above, F.col("of").eqNullSafe(F.col(group))).select(
            "of", "top", F.lit(0).cast("bigint").alias("at"), F.col("steps").alias("up"), *extra
        )
    )
    below = None
    for k in range(max(0, len(levels) - 2), -1, -1):
        upper = starts.where(F.col("top") == k).drop("top")
        upper = upper if below is None else upper.union(below)
        blocks = _blocks(levels[k], group, k * stride, arity, stride, payload if k == 0 else ())
        joined = blocks.join(upper, F.col(group).eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
        stages = [F.col("nodes.hash")]
        for step in range(1, stride):
            stages.append(F.when(F.col("height") > step, _up(stages[-1], arity)))
        names = [f"level_{i}" for i in range(stride)]
        exploded = joined.withColumns(dict(zip(names, stages))).select(
            group, "n", "height", "up", *extra, *names, F.posexplode("nodes").alias("place", "node")
        )
        steps = [
            F.when(F.col("height") > i, _sides(F.col(name), F.floor(F.col("place") / arity**i).cast("int"), arity))
            for i, name in enumerate(names)
        ]
        own = F.filter(F.array(*steps), lambda s: s.isNotNull())
        rows = exploded.select(
            group,
            F.col("node.pos").alias("pos"),
            F.col("node.hash").alias("hash"),
            "n",
            *(F.col(f"node.{c}").alias(c) for c in (payload if k == 0 else ())),
            F.concat(own, F.col("up")).alias("steps"),
            *extra,
        )
        if k:
            below = written(rows.select(F.col(group).alias("of"), F.col("pos").alias("at"), F.col("steps").alias("up"), *extra))
    return rows


def dataset_proofs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    claimed: Column | None = None,
    arity: int = ARITY,
    stride: int = STRIDE,
    folder: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``leaf``, ``claimed`` (another leaf for it, if the
    column expression ``claimed`` over ``docs`` is given, else null), ``subroot`` of its group,
    ``root``, and ``steps``, its proof. The levels stay in ``folder`` if one is named.

    Leaves of a group ascend by id, null ids first, equal ids by leaf; groups ascend bytewise,
    the null group first. Nulls in a field are marked, an empty text is not null. Repeated
    rows are leaves of their own, with places and proofs of their own. Only ``fields``, id and
    group are read, so further columns do no harm. Texts of any length are hashed whole where
    they are read; from then on a row is a few hashes. An empty table gives an empty one."""
    folder = folder or shared_folder(docs.sparkSession)
    named = lambda c: F.col(f"`{c}`")
    leaves = written(
        docs.select(
            named(group_col).alias("tree"),
            named(id_col).alias("id"),
            leaf([named(c) for c in fields]).alias("hash"),
            (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
        ),
        f"{folder}/leaves",
    )
    levels = build(leaves, "tree", ["id", "hash"], arity, stride, f"{folder}/groups")
    remove_path(docs.sparkSession, f"{folder}/leaves")
    subroots = roots(levels, "tree", arity, stride).withColumn("all", F.lit(0))
    top = build(subroots, "all", ["tree"], arity, stride, f"{folder}/root")
    bottom = docs.sparkSession.range(1).select(F.col("id").cast("int").alias("all"), F.array().cast(STEPS).alias("steps"))
    above = written(prove(top, "all", bottom, arity, stride).select("tree", "steps", F.col("hash").alias("subroot")))
    above = above.withColumn("root", fold(F.col("subroot"), F.col("steps")))
    proofs = prove(levels, "tree", above, arity, stride)
    return proofs.select(
        F.col("id").alias(id_col), F.col("hash").alias("leaf"), "claimed", "subroot", "root", "steps"
    )


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, start, lambda node, s: hash_of(s["left"], node, s["right"]))


def siblings(steps: Column) -> Column:
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")
