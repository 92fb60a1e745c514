"""Substring deduplication: winnowed anchors as seeds, extended to maximal repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch

# Words of a window that must repeat, and of the seed of an anchor.
WINDOW = 50
SEED = 6
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Positions whose windows are searched at once; bounds memory on very long texts.
BLOCK = 1 << 16


def _words(text: str | None) -> tuple[list[bytes], bytes, np.ndarray, np.ndarray]:
    """The words, the text they make when joined by one space, and where each starts and
    ends in it."""
    words = (text or "").encode().split()
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(words) else ends
    return words, b" ".join(words), starts, ends


def anchors(text: str | None, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Of a text: seed hash, hash of the stretch, first and last window, word at which the seed
    stands, one entry per anchor.

    The anchor of a window is its seed of smallest hash, the leftmost if several are equal, so
    equal windows have equal anchors in equal places. Neighbouring windows with one anchor
    form a stretch, and each window lies in exactly one. Where a text repeats itself, equal
    stretches that follow each other are one entry: what holds for one holds for all.
    """
    words, joined, starts, ends = _words(text)
    n = len(words) - window + 1
    if n < 1:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - seed + 1, np.uint64)
    for k in range(seed):
        mixed = mixed * _FACTOR + hashes[k : k + len(mixed)]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTOR
    width = window - seed + 1
    place = np.concatenate(
        [
            np.lib.stride_tricks.sliding_window_view(mixed[at : at + BLOCK + width - 1], width).argmin(axis=1) + at
            for at in range(0, n, BLOCK)
        ]
    ) + np.concatenate([np.arange(min(BLOCK, n - at)) for at in range(0, n, BLOCK)])
    first = np.flatnonzero(np.concatenate(([True], np.diff(place) != 0)))
    last = np.append(first[1:], n) - 1
    digest = xxhash.xxh3_64_intdigest
    stretches = np.fromiter(
        (digest(joined[a:b]) for a, b in zip(starts[first].tolist(), ends[last + window - 1].tolist())),
        np.uint64,
        len(first),
    )
    seeds = mixed[place[first]]
    other = np.flatnonzero(np.concatenate(([True], (np.diff(seeds) != 0) | (np.diff(stretches) != 0))))
    last = last[np.append(other[1:], len(first)) - 1]
    return seeds[other].view(np.int64), stretches[other].view(np.int64), first[other], last, place[first][other]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("key"), F.col(f"`{text_col}`").alias("text")
    )


def _anchor_rows(rows: DataFrame, window: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(v.as_py(), window, seed) for v in batch.column(2)]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]), pa.int64())
            columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), *map(pa.array, columns[:2])]
                + [pa.array(c.astype(np.int32)) for c in columns[2:]],
                names=names,
            )

    names = ["id", "key", "seed", "stretch", "first", "last", "place"]
    kinds = [T.LongType(), T.LongType(), T.IntegerType(), T.IntegerType(), T.IntegerType()]
    fields = [*rows.schema.fields[:2], *(T.StructField(n, k) for n, k in zip(names[2:], kinds))]
    return rows.where("id is not null").mapInArrow(run, T.StructType(fields))


def _spread(rows: DataFrame, window: int) -> DataFrame:
    """For the stretches ``asked`` of each row, those of a pair as the words around their anchor
    (``kind`` "pair"), all others window by window, as two hashes (``kind`` "window")."""
    fields = [
        T.StructField("kind", T.StringType()),
        *rows.schema.fields[:2],
        T.StructField("first", T.IntegerType()),
        T.StructField("w1", T.LongType()),
        T.StructField("w2", T.LongType()),
        T.StructField("seed", T.LongType()),
        T.StructField("smaller", T.BooleanType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("around", T.BinaryType()),
    ]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [pa.string(), batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            kinds += [pa.bool_(), pa.int32(), pa.binary()]

            def made(i: int, n: int, values: dict[str, pa.Array]) -> pa.RecordBatch:
                owner = pa.array(np.full(n, i), pa.int64())
                values |= {"id": batch.column(0).take(owner), "key": batch.column(1).take(owner)}  # noqa: B023
                return pa.RecordBatch.from_arrays(
                    [values.get(c, pa.nulls(n, kinds[k])) for k, c in enumerate(names)],  # noqa: B023
                    names=names,
                )

            for i in range(batch.num_rows):
                _, joined, starts, ends = _words(batch.column(2)[i].as_py())
                asked = batch.column(3)[i].as_py()
                pairs = [s for s in asked if s["smaller"] is not None]
                if pairs:
                    yield made(
                        i,
                        len(pairs),
                        {
                            "kind": pa.array(["pair"] * len(pairs)),
                            "first": pa.array([s["first"] for s in pairs], pa.int32()),
                            "seed": pa.array([s["seed"] for s in pairs], pa.int64()),
                            "smaller": pa.array([s["smaller"] for s in pairs]),
                            "at": pa.array([s["place"] - s["first"] for s in pairs], pa.int32()),
                            "around": pa.array(
                                [joined[starts[s["first"]] : ends[s["last"] + window - 1]] for s in pairs], pa.binary()
                            ),
                        },
                    )
                places = sorted({p for s in asked if s["smaller"] is None for p in range(s["first"], s["last"] + 1)})
                for at in range(0, len(places), BLOCK):
                    part = np.array(places[at : at + BLOCK])
                    digests = b"".join(
                        xxhash.xxh3_128_digest(joined[a:b])
                        for a, b in zip(starts[part].tolist(), ends[part + window - 1].tolist())
                    )
                    halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                    yield made(
                        i,
                        len(part),
                        {
                            "kind": pa.array(["window"] * len(part)),
                            "first": pa.array(part.astype(np.int32)),
                            "w1": pa.array(halves[:, 0].copy()),
                            "w2": pa.array(halves[:, 1].copy()),
                        },
                    )

    return rows.mapInArrow(run, T.StructType(fields))


def extend(words: list[bytes], at: int, others: list[bytes], other_at: int, seed: int) -> tuple[int, int] | None:
    """The longest run of equal words around a seed that both have, as the first word and the
    one behind the last of ``words``; None if the seeds differ."""
    if words[at : at + seed] != others[other_at : other_at + seed]:
        return None
    left = 0
    while left < min(at, other_at) and words[at - left - 1] == others[other_at - left - 1]:
        left += 1
    right = seed
    most = min(len(words) - at, len(others) - other_at)
    while right < most and words[at + right] == others[other_at + right]:
        right += 1
    return at - left, at + right


def _extended(pairs: DataFrame, window: int, seed: int) -> DataFrame:
    """Spans of the larger of two rows that share a seed, matched both ways from it."""
    own = pairs.where("not smaller").select("seed", "id", "key", "first", "at", "around")
    # The smaller row may hold its stretch in several places; they are equal.
    other = pairs.where("smaller").groupBy("seed").agg(F.min(F.struct("first", "at", "around")).alias("o"))
    met = own.join(other, "seed").select("id", "key", "first", "at", "around", F.col("o.at").alias("other_at"), F.col("o.around").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = [], []
            for i in range(batch.num_rows):
                first, at, around, other_at, other = (batch.column(k)[i].as_py() for k in range(2, 7))
                run_of = extend(around.split(b" "), at, other.split(b" "), other_at, seed)
                if run_of and run_of[1] - run_of[0] >= window:
                    rows.append(i)
                    spans.append((first + run_of[0], first + run_of[1] - window))
            owner = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner)]
                + [pa.array([s[k] for s in spans], pa.int32()) for k in range(2)],
                names=["id", "key", "first", "last"],
            )

    fields = [*met.schema.fields[:3], T.StructField("last", T.IntegerType())]
    return met.mapInArrow(run, T.StructType(fields))


def strip_words(text: str | None, spans: list[dict[str, int]] | None, window: int = WINDOW) -> tuple[list[bytes], list[bytes]]:
    """All words, and those outside every window that starts from ``first`` to ``last``."""
    words = (text or "").encode().split()
    if not spans:
        return words, words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [s["first"] for s in spans], 1)
    np.add.at(change, [s["last"] + window for s in spans], -1)
    keep = np.cumsum(change[:-1]) == 0
    return words, [w for w, k in zip(words, keep.tolist()) if k]


def repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """The windows that also start in a row with a smaller id: ``id``, ``key`` (hash of the
    text), ``first`` and ``last`` of a run of them, for the rows that have any. Together the
    words they cover are the maximal repeats of at least ``window`` words.

    1. Seed: rows meet on the hash of an anchor. An anchor of one document ends here.
    2. Stretches around an anchor that are equal as a whole: all rows but the smallest repeat
       them. From here on the smallest row stands for its stretch.
    3. Extend: where an anchor has two different stretches, the words of the larger row are
       compared with those of the smaller one, to the left and to the right of the seed, and
       a run of ``window`` words or more is a span.
    4. Where it has more, several partners can overlap, and pairs would grow with the square
       of their number: there windows meet by 128-bit hash, and all rows but the smallest
       repeat them.

    No step pairs the rows of a group: each takes its smallest id, combined before the
    shuffle, and gives it back to the rows by a join. The smallest ids are written first, so
    that the join has both its sides straight from a shuffle, and Spark can split the rows of
    a key that very many have. A passage that very many documents share costs one row per
    document and anchor.
    """
    scratch = Scratch(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col)
    found = scratch.table(_anchor_rows(rows, window, seed))
    shared = scratch.table(
        found.groupBy("seed").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most").select("seed")
    )
    met = scratch.table(found.join(shared, "seed", "left_semi"))
    scratch.remove(found, shared)
    classes = scratch.table(
        met.groupBy("seed", "stretch").agg(
            F.min("id").alias("least"), F.max(F.col("last") - F.col("first")).alias("span")
        )
    )
    # A stretch longer than an anchor reaches is a text that repeats itself.
    seeds = scratch.table(
        classes.groupBy("seed").agg(
            F.count(F.lit(1)).alias("classes"),
            F.min("least").alias("smallest"),
            F.max("least").alias("second"),
            ((F.count(F.lit(1)) == 2) & (F.max("span") <= window - seed)).alias("is_pair"),
        )
    )
    least = scratch.table(classes.join(seeds, "seed").drop("span"))
    scratch.remove(classes, seeds)
    is_smallest = F.col("id") == F.col("least")
    judged = scratch.table(
        met.join(least, ["seed", "stretch"])
        .select(
            "id",
            "key",
            "first",
            "last",
            (~is_smallest).alias("whole"),
            F.when(is_smallest, F.col("seed")).alias("seed"),
            F.when(is_smallest, F.col("place")).alias("place"),
            F.when(F.col("is_pair"), F.col("least") == F.col("smallest")).alias("smaller"),
            # One class, or two with one smallest row: nothing is left to compare.
            ((F.col("classes") > 1) & (F.col("smallest") < F.col("second"))).alias("differs"),
        )
        .where("whole or differs")
        .select("id", "key", "first", "last", "whole", "seed", "place", F.expr("if(whole, null, smaller)").alias("smaller"))
        .distinct()
    )
    scratch.remove(met, least)
    asked = judged.where("not whole").groupBy("id", "key").agg(
        F.collect_list(F.struct("first", "last", "seed", "place", "smaller")).alias("asked")
    )
    # Rows equal in id and text have the same windows, so their spans are the same.
    asked = scratch.table(asked)
    spread = scratch.table(
        _spread(rows.join(asked, ["id", "key"]).select("id", "key", "text", "asked"), window)
    )
    scratch.remove(asked)
    windows = spread.where("kind = 'window'")
    smallest = scratch.table(
        windows.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most").drop("most")
    )
    single = (
        windows.select("w1", "w2", "id", "key", "first")
        .join(smallest, ["w1", "w2"])
        .where("id > least")
        .select("id", "key", "first", F.col("first").alias("last"))
    )
    matched = _extended(spread.where("kind = 'pair'"), window, seed)
    spans = judged.where("whole").select("id", "key", "first", "last").union(single).union(matched)
    result = scratch.table(spans.distinct())
    scratch.keep_only(result)
    return result


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_text`` (the words
    that stay, joined by one space), ``kept_sha256``.

    A word goes if a window over it also starts in a row with a smaller id; windows are
    judged on the texts as given. A null text has no words; a text of fewer words than a
    window is left alone, and so is a row with a null id, which takes nothing from others
    either. Rows with one id never take from each other; repeated rows are treated alike. An
    empty table gives an empty one. Other columns are not read.
    """
    spans = (
        repeats(docs, id_col=id_col, text_col=text_col, window=window, seed=seed)
        .groupBy("id", "key")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    )
    rows = _keyed(docs, id_col, text_col).join(spans, ["id", "key"], "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts, digests = [], [], []
            for text, span in zip(batch.column(1), batch.column(2)):
                words, kept = strip_words(text.as_py(), span.as_py(), window)
                joined = b" ".join(kept)
                counts.append((len(words), len(words) - len(kept)))
                texts.append(joined.decode())
                digests.append(hashlib.sha256(joined).hexdigest())
            numbers = np.array(counts, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(numbers[:, 0].copy()),
                    pa.array(numbers[:, 1].copy()),
                    pa.array(texts, pa.string()),
                    pa.array(digests, pa.string()),
                ],
                names=["id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    fields = [
        rows.schema["id"],
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    return rows.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_col)
