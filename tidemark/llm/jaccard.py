"""Near-duplicates by the exact Jaccard similarity of word shingles, through rare shingles,
joined with the links of SimHash fingerprints."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import near_pairs

SHINGLE = 5
SIMILARITY = 0.8
# Rows looked at to learn which shingles are common, and how many of those are told to all
# tasks. They only order the shingles of a text; no order leaves a pair out.
SAMPLE = 8192
COMMON = 100_000
# Longs of a text's parities: a power of two, with three bits for four shingles up to the most.
PARITY_LONGS, MOST_LONGS = 8, 64
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles of a text, ASCII letters lower-cased,
    rising. A text of fewer words has one, of all its words; without words it has none."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    mixed = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        mixed = mixed * _FACTOR + hashes[k : k + len(mixed)]
    return np.unique(mixed)


def node(tokens: np.ndarray) -> int:
    """What stands for all texts with these shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def prefix(
    tokens: np.ndarray, common: np.ndarray, times: np.ndarray, similarity: float = SIMILARITY
) -> tuple[np.ndarray, int]:
    """The rarest shingles, so many that two similar texts have one of them in common, and
    how many of all are not among the ``common`` ones (rising, found ``times``).

    Texts of n shingles that are similar share ``similarity * n`` of them, so the first in
    the order that they share has fewer than n minus that many before it."""
    n = len(tokens)
    if not n:
        return tokens, 0
    weight = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        weight = np.where(common[at] == tokens, times[at], 0)
    length = n - math.ceil(similarity * n - 1e-9) + 1
    return tokens[np.argsort(weight, kind="stable")[:length]], int((weight == 0).sum())


def parities(tokens: np.ndarray) -> np.ndarray:
    """Per bit whether an odd number of shingles falls on it. Two texts differ in at least as
    many shingles as parities. Long texts have more bits; as their number is a power of two,
    the halves of a longer row laid over each other are the parities of half the bits."""
    longs = PARITY_LONGS
    while longs < MOST_LONGS and 64 * longs < 0.75 * len(tokens):
        longs *= 2
    bits = longs * 64
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _common(docs: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    every = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64(F.lit(1), f"`{text_col}`"), F.lit(every)) == 0).select(
        F.col(f"`{text_col}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text.as_py(), shingle).view(np.int64) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found]))], names=["token"])

    found = (
        some.mapInArrow(run, "token bigint")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("times"))
        .where("times > 2")
        .orderBy(F.desc("times"), "token")
        .limit(COMMON)
        .collect()
    )
    common = np.array([r.token for r in found], np.int64).view(np.uint64)
    order = np.argsort(common)
    return common[order], np.array([r.times for r in found], np.int64)[order]


def _described(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """Rows ``id``, ``content`` (hash of the text), ``node``, ``n`` (shingles), ``light``
    (those not common), ``parity``, ``prefix``, one for each row of ``docs``."""
    common, times = _common(docs, text_col, shingle)
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("content"), F.col(f"`{text_col}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(2):
                tokens = shingles(text.as_py(), shingle)
                first, light = prefix(tokens, common, times, similarity)
                rows.append((node(tokens), len(tokens), light, parities(tokens), first.view(np.int64)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.list_(pa.int64())),
                    pa.array(columns[4], pa.list_(pa.int64())),
                ],
                names=["id", "content", "node", "n", "light", "parity", "prefix"],
            )

    longs = T.ArrayType(T.LongType())
    fields = [
        narrow.schema["id"],
        narrow.schema["content"],
        *(T.StructField(name, T.LongType()) for name in ("node", "n", "light")),
        T.StructField("parity", longs),
        T.StructField("prefix", longs),
    ]
    return narrow.mapInArrow(run, T.StructType(fields))


def _sizes_fit(a: str, b: str, similarity: float) -> Column:
    """False only for rows whose numbers of shingles rule it out that they are similar."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(n_a, n_b) >= F.lit(similarity) * F.greatest(n_a, n_b) - F.lit(1e-6)


def _places_fit(a: str, b: str, similarity: float) -> Column:
    """False only for rows that are not similar, or share an earlier shingle of their prefixes.

    Those are in one order for all texts, so what two share lies at or after the first that
    they share: it must leave as many shingles as similar sets have in common. Sizes that do
    not fit leave too few at any place."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    both = F.lit(similarity / (1 + similarity)) * (n_a + n_b) - F.lit(1e-6)
    return F.least(n_a - F.col(f"{a}.place"), n_b - F.col(f"{b}.place")) >= both


def _parities_fit(a: str, b: str, similarity: float) -> Column:
    """The same for their parities. Sizes that fit are close, so one row of parities has at
    most twice as many longs as the other."""
    one, two = F.col(f"{a}.parity"), F.col(f"{b}.parity")
    xor = lambda x, y: F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))
    fold = lambda x, size: xor(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size))
    count = lambda x: F.aggregate(x, F.lit(0), lambda n, p: n + F.bit_count(p))
    short = F.lit(0)
    for k in range(PARITY_LONGS):
        short = short + F.bit_count(F.get(one, k).bitwiseXOR(F.get(two, k)))
    differ = (
        F.when((F.size(one) == PARITY_LONGS) & (F.size(two) == PARITY_LONGS), short)
        .when(F.size(one) == F.size(two), count(xor(one, two)))
        .when(F.size(one) == 2 * F.size(two), count(xor(fold(one, F.size(two)), two)))
        .when(F.size(two) == 2 * F.size(one), count(xor(fold(two, F.size(one)), one)))
        .otherwise(0)
    )
    most = F.lit((1 - similarity) / (1 + similarity)) * (F.col(f"{a}.n") + F.col(f"{b}.n")) + F.lit(1e-6)
    return differ <= most


def _verified(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str, shingle: int, similarity: float, scratch: Scratch
) -> DataFrame:
    """Those of the pairs of nodes ``a``, ``b`` that are similar, from their texts. Each node's
    text is read and hashed once; one set travels with a pair, to where the other is."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    needed = scratch.table(nodes.select("node", "content").join(ends, "node").select("content"))
    texts = docs.select(F.xxhash64(f"`{text_col}`").alias("content"), F.col(f"`{text_col}`").alias("text")).join(
        needed, "content", "left_semi"
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingles(text.as_py(), shingle) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node(t) for t in tokens], pa.int64()), pa.array([t.tobytes() for t in tokens], pa.binary())],
                names=["node", "tokens"],
            )

    # Repeated rows give a set again; their first is kept before the shuffle.
    sets = texts.select("text").mapInArrow(describe, "node bigint, tokens binary").groupBy("node").agg(F.first("tokens").alias("tokens"))
    sets = scratch.table(sets)
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b")), "b"
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = ([np.frombuffer(v.as_py(), np.uint64) for v in batch.column(k)] for k in (2, 3))
            kept = [similar(a, b, similarity) for a, b in zip(*sides)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    kept = scratch.table(joined.select("a", "b", "of_a", "of_b").mapInArrow(keep, "a bigint, b bigint"))
    scratch.remove(needed, sets)
    return kept


def _ends(one: str, two: str) -> tuple[Column, Column]:
    return F.least(one, two).alias("a"), F.greatest(one, two).alias("b")


def _fingerprint_pairs(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of nodes with the components of all links of op1, from the fingerprints ``fp`` of
    each ``node``: one node stands for those of equal fingerprints, is paired with each of them,
    and with those that stand for the fingerprints within the distance of op1. Copies of one
    fingerprint are never all paired."""
    groups = scratch.table(prints.groupBy("fp").agg(F.min("node").alias("least")))
    same = prints.join(groups, "fp").where("node <> least").select(*_ends("node", "least"))
    end = lambda c, name: groups.select(F.col("fp").alias(c), F.col("least").alias(name))
    met = near_pairs(groups.select("fp")).distinct()
    apart = met.join(end("a", "one"), "a").join(end("b", "two"), "b").where("one <> two").select(*_ends("one", "two"))
    return same.union(apart)


def _hub_pairs(index: DataFrame, order: Column, similarity: float, scratch: Scratch) -> DataFrame:
    """Pairs of the first node in ``order`` of each ``token`` with its other nodes, those of the
    same ``root`` left out: at most one for each row of ``index``."""
    row = F.struct(order.alias("order"), "node", "n", "place", "root")
    hubs = scratch.table(index.groupBy("token").agg(F.min(row).alias("c"))).select("token", "c.*")
    met = (F.col("l.token") == F.col("r.token")) & (F.col("l.root") != F.col("r.root")) & _places_fit("l", "r", similarity)
    return index.alias("l").join(hubs.alias("r"), met).select(*_ends("l.node", "r.node"))


def _open(rows: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of shingles whose nodes are not all in one component, with its ``root``."""
    rooted = scratch.table(
        rows.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    apart = rooted.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    apart = scratch.table(apart.select("token"))
    left = scratch.table(rooted.join(apart, "token", "left_semi"))
    scratch.remove(rooted, apart)
    return left


def _one_token_a_set(index: DataFrame) -> DataFrame:
    """The rows of one shingle for each set of nodes: of shingles that the same nodes have, the
    first in the order of prefixes, which any node tells. Sets are compared by their size and
    two independent sums of 64-bit hashes."""
    sets = index.groupBy("token").agg(
        F.min(F.struct("node", "place")).alias("least"),
        F.count(F.lit(1)).alias("nodes"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two"),
    )
    first = sets.groupBy("least.node", "nodes", "one", "two").agg(F.min_by("token", "least.place").alias("token"))
    return index.join(first.select("token"), "token", "left_semi")


def _links(
    nodes: DataFrame, given: DataFrame, docs: DataFrame, text_col: str, shingle: int, similarity: float, scratch: Scratch
) -> DataFrame:
    """Pairs of nodes ``a`` < ``b`` with the components of all similar pairs and all ``given``
    ones, which count as they are.

    1. Of the nodes that share a shingle of their prefixes each is compared with the one of
       fewest rare shingles. A shingle of one node ends here.
    2. Of the nodes that share one and are not in one component each is compared with one that
       a hash picks, another one for each shingle.
    3. Pairs that share one and are not in one component by then meet in a join, on one shingle
       for each set of nodes.

    All compare sizes and parities first and verify what is left. Any similar pair either is
    in one component after step 2 or meets in step 3, so no component is left in parts. Steps
    1 and 2 make at most a pair for each row of the index. Rows of the index are a shingle, a
    node, its place there and its sizes; parities are fetched for pairs, and for the rows of
    step 3.
    """
    tokens = nodes.select("node", "n", "light", F.posexplode("prefix").alias("place", "token"))
    shared = scratch.table(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1").select("token"))
    index = scratch.table(tokens.join(shared, "token", "left_semi").withColumn("root", F.col("node")))
    scratch.remove(shared)
    parity = lambda end: nodes.select(F.col("node").alias(end), F.struct("n", "parity").alias(f"of_{end}"))

    def fitting(pairs: DataFrame) -> DataFrame:
        both = pairs.distinct().join(parity("a"), "a").join(parity("b"), "b")
        fit = _sizes_fit("of_a", "of_b", similarity) & _parities_fit("of_a", "of_b", similarity)
        return scratch.table(both.where(fit).select("a", "b"))

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, nodes, docs, text_col, shingle, similarity, scratch)

    by_light = _hub_pairs(index, F.col("light"), similarity, scratch)
    spokes = fitting(by_light)
    links = given.union(verified(spokes))
    left = _open(index, connected_components(links, scratch.subfolder()), scratch)
    scratch.remove(index)
    by_hash = _hub_pairs(left, F.xxhash64("token", "node"), similarity, scratch)
    more = fitting(by_hash.join(spokes, ["a", "b"], "left_anti"))
    links = links.union(verified(more))
    last = _open(left, connected_components(links, scratch.subfolder()), scratch)
    scratch.remove(left)
    wide = scratch.table(_one_token_a_set(last).join(nodes.select("node", "parity"), "node"))
    scratch.remove(last)
    rest = scratch.table(
        wide.alias("l")
        .join(
            wide.alias("r"),
            (F.col("l.token") == F.col("r.token"))
            & (F.col("l.node") < F.col("r.node"))
            & (F.col("l.root") != F.col("r.root"))
            & _places_fit("l", "r", similarity)
            & _parities_fit("l", "r", similarity),
        )
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        .distinct()
        .join(spokes.union(more), ["a", "b"], "left_anti")
    )
    scratch.remove(wide, spokes, more)
    return links.union(verified(rest))


def deduplicate(
    docs: DataFrame,
    *,
    prints: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs``, all columns, with one of each component of linked texts: the row
    of the smallest id, null ids last; of several such rows, one of those with the smallest
    hash of the text. Texts are linked if their shingles have a Jaccard similarity of at least
    ``similarity`` and, where ``prints`` gives the ``fingerprints`` of all rows, if op1 links
    these. A component may hold links of both kinds.

    Texts without words, null ones among them, are alike, and similar to no other; their
    fingerprint, zero, links like any other. Of repeated rows one stays. Shingles are compared
    by 64-bit hashes; texts are read whole, a very long one as one array of hashes in its task.
    Other columns are carried along under any name. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    described = scratch.table(_described(docs, id_col, text_col, shingle, similarity))
    rows = scratch.table(described.select("id", "content", "node"))
    # Texts of equal shingles are one node from here on.
    nodes = scratch.table(
        described.groupBy("node").agg(F.min("content").alias("content"), *(F.first(c).alias(c) for c in ("n", "light", "parity", "prefix")))
    )
    scratch.remove(described)
    if prints is None:
        given = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    else:
        printed = prints.select("content", "fp").distinct().join(rows.select("content", "node").distinct(), "content")
        given = scratch.table(_fingerprint_pairs(scratch.table(printed.select("node", "fp").distinct()), scratch))
    links = _links(nodes, given, docs, text_col, shingle, similarity, scratch)
    roots = connected_components(links, scratch.subfolder())
    key = lambda id_value, content: F.struct(
        id_value.isNull().alias("no_id"), id_value.alias("id"), content.alias("content")
    )
    kept = scratch.table(
        rows.select("node", key(F.col("id"), F.col("content")).alias("key"))
        .join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    scratch.keep_only(kept)
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
