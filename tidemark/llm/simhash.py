"""SimHash near-duplicates through deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written
from tidemark.llm.components import connected_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
# Shingle hashes whose bits are counted at once; bounds memory on very long texts.
HASH_BLOCK = 1 << 15

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits of a text as a signed number: each is 1 if set in over half of the hashes of
    the word shingles, repeats included. Null and empty texts have 0."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), HASH_BLOCK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(first[at : at + HASH_BLOCK], last[at : at + HASH_BLOCK])],
            dtype=">u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(first)).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Rows ``id``, ``content`` (hash of the text), ``fp``, one for each row of ``docs``."""
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("content"), F.col(f"`{text_col}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], names=["id", "content", "fp"]
            )

    fields = [narrow.schema["id"], narrow.schema["content"], T.StructField("fp", T.LongType())]
    return narrow.mapInArrow(run, T.StructType(fields))


def segments(distance: int = DISTANCE, bits: int = BITS) -> list[tuple[int, int, bool]]:
    """Segments (offset, length, with wildcard) of a fingerprint such that two that differ in
    at most ``distance`` bits agree on one: by at most one bit where it has a wildcard, else
    wholly.

    With w wildcard and e exact segments a pair that agrees on none differs in at least
    2w + e bits, so 2w + e = distance + 1 is enough. The lengths are those for which random
    fingerprints meet least often.
    """
    wild, exact = (distance + 1) // 2, (distance + 1) % 2
    best = None
    for length in range(1, bits // max(wild, 1) + 1) if wild else [0]:
        rest = bits - wild * length
        if (exact == 0) != (rest == 0) and not (exact == 0 and rest < wild):
            continue
        lengths = [length + (i < rest and not exact) for i in range(wild)] + [rest] * exact
        cost = sum((n + 1) / 2.0**n for n in lengths[:wild]) + sum(2.0**-n for n in lengths[wild:])
        if best is None or cost < best[0]:
            best = (cost, lengths)
    out, offset = [], 0
    for i, length in enumerate(best[1]):
        out.append((offset, length, i < wild))
        offset += length
    return out


def _variants(fp: Column, distance: int) -> Column:
    """Index keys of a fingerprint: (segment, removed bit or -1, what is left, the bit)."""
    keys: list[Column] = []

    def key(segment: int, gap: int, rest: Column, bit: Column) -> Column:
        return F.struct(
            F.lit(segment * 128 + gap + 1).alias("tag"), rest.alias("rest"), bit.cast("int").alias("bit")
        )

    for number, (offset, length, wild) in enumerate(segments(distance)):
        mask = (1 << length) - 1
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        value = F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit(mask).cast("bigint"))
        keys.append(key(number, -1, value, F.lit(None)))
        for gap in range(length if wild else 0):
            low = value.bitwiseAND(F.lit((1 << gap) - 1).cast("bigint"))
            high = F.shiftleft(F.shiftrightunsigned(value, gap + 1), gap)
            keys.append(key(number, gap, high.bitwiseOR(low), F.shiftrightunsigned(value, gap).bitwiseAND(F.lit(1).cast("bigint"))))
    return F.array(*keys)


def near_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a`` < ``b`` of the distinct fingerprints ``fp`` that differ in 1 to
    ``distance`` bits, each at least once.

    Each segment is indexed whole and, where it has a wildcard, once with each bit removed.
    Whole keys meet each other; a key without a bit meets only those in which that bit was
    the other one, so a pair meets once for each way it agrees. Pairs are verified inside the
    join and only links leave it. A key many fingerprints share is split by the join's skew
    handling; no pair is left out.
    """
    index = prints.select("fp", F.explode(_variants(F.col("fp"), distance)).alias("k")).select("fp", "k.*")
    left = index.where("bit is null or bit = 0").alias("l")
    right = index.where("bit is null or bit = 1").alias("r")
    met = (
        (F.col("l.tag") == F.col("r.tag"))
        & (F.col("l.rest") == F.col("r.rest"))
        & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= distance)
        & (F.col("l.bit").isNotNull() | (F.col("l.fp") < F.col("r.fp")))
    )
    return left.join(right, met).select(
        F.least("l.fp", "r.fp").alias("a"), F.greatest("l.fp", "r.fp").alias("b")
    )


def near_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per row of ``docs``: id, ``content`` (hash of the text), ``fingerprint`` (16
    hex digits), ``component_id`` (smallest id its links reach, its own included),
    ``component_size`` (rows), ``links`` (other fingerprints within the distance).

    Rows with equal fingerprints are one node, so copies are never paired. Null and empty
    texts have fingerprint zero and link like any other. Null ids are passed over as
    ``component_id`` unless a component has no other. A repeated row is a row of its own. An
    empty table gives an empty one. Other columns are not read.
    """
    prints = written(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
    pairs = written(near_pairs(nodes.select("fp"), distance).distinct())
    roots = connected_components(pairs)
    ends = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp")))
    linked = ends.groupBy("fp").agg(F.count(F.lit(1)).alias("links"))
    rooted = written(
        nodes.join(linked, "fp", "left")
        .join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp"))
    )
    # Written, so that the join has both sides straight from a shuffle and Spark can split the
    # fingerprints of a component that holds very many.
    whole = written(
        rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("component_size"))
    )
    named = rooted.join(whole, "root").select(
        "fp", "component_id", "component_size", F.coalesce("links", F.lit(0)).cast("bigint").alias("links")
    )
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col),
        "content",
        F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"),
        "component_id",
        "component_size",
        "links",
    )


def deduplicate(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options: int
) -> DataFrame:
    """The rows of ``docs``, all columns, with one of each component: the row of the smallest
    id; of several such rows, one of those with the smallest hash of the text."""
    classes = near_classes(docs, id_col=id_col, text_col=text_col, **options)
    key = lambda id_value, content: F.struct(
        id_value.isNull().alias("no_id"), id_value.alias("id"), content.alias("content")
    )
    kept = (
        classes.select("component_id", "fingerprint", key(F.col(f"`{id_col}`"), F.col("content")).alias("key"))
        .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")))
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    row = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row"),
        key(F.col(f"`{id_col}`"), F.xxhash64(f"`{text_col}`")).alias("key"),
    )
    return (
        row.join(kept, "key", "left_semi")
        .groupBy("key")
        .agg(F.first("row").alias("row"))
        .select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
    )
