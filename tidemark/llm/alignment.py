"""Cross-tokenizer alignment: overlap links of two tokenizations, counted over the corpus."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain
from math import ceil
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch

TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text aligned at once, and links after which a task writes its run.
PART_BYTES = 1 << 20
RUN_LINKS = 1 << 22
# Parts of the ids of the second tokenizer, and bits of an id or of a place in a run.
RADIX = 32
BITS = 20
# Runs merged at once, and runs for which the totals of a radix are copied once.
FAN_IN = 64
RUNS_PER_COPY = 256
# Entries of a run that a merge takes at once.
BLOCK = 1 << 14
# Fixed value: how the first tokenizer cuts text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space of this length is left to the slower library, whose pattern needs no stack.
LONG_SPACE = 4096


def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the rest in order from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers from the content of their files, with the bytes of every id."""

    def __init__(self, first: bytes, second: bytes):
        self.slow = tokenizers.Tokenizer.from_str(first.decode())
        self.slow.encode_special_tokens = True
        model = json.loads(first)["model"]
        byte_of = _byte_of()
        as_bytes = lambda t: bytes(byte_of[c] for c in t)
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
        self.first = [b""] * (max(self.slow.get_vocab().values()) + 1)
        for token, number in vocabulary.items():
            self.first[number] = as_bytes(token)
        # Ids in the order of the merges are ranks, which the faster library needs.
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ranked = all(vocabulary.get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merges))
        self.fast = None
        if ranked and len(vocabulary) == 256 + len(merges):
            ranks = {self.first[i]: i for i in vocabulary.values()}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=second)
        self.second = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size()))
        ]

    def encode_first(self, text: str) -> list[int]:
        if self.fast is None or _longest_space(text) >= LONG_SPACE:
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode_second(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


def _longest_space(text: str) -> int:
    """0 for texts that cannot have a long run of white space."""
    if len(text) < LONG_SPACE or sum(map(len, text.split())) + LONG_SPACE > len(text):
        return 0
    longest = run = 0
    for c in text:
        run = run + 1 if c.isspace() else 0
        longest = max(longest, run)
    return longest


def _digits(size: int) -> np.ndarray:
    """Per id its decimal digits, zero bytes in front, and room for what follows it."""
    width = len(str(max(size - 1, 0)))
    text = np.char.encode(np.arange(size).astype(f"U{width}"))
    table = np.zeros((size, width + 1), np.uint8)
    table[:, :width] = text.view(np.uint8).reshape(size, width)
    return table


class Aligner:
    """Tokens of both sides of a text, groups and links."""

    def __init__(self, first: bytes, second: bytes):
        self.tokenizers = Tokenizers(first, second)
        sides = self.tokenizers.first, self.tokenizers.second
        self.length = [np.array([len(t) for t in side], np.int64) for side in sides]
        size = max(map(len, sides))
        if size >= 1 << BITS:
            raise ValueError("a vocabulary is too large for the layout of a link")
        self.digits = _digits(size)

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Per text (tokens of A, of B, groups, links, digest); per link its text and its ids
        as ``b << BITS | a``. A text without tokens has zeros, and '' as digest."""
        kept, ids = [], ([], [])
        second = self.tokenizers.encode_second(texts)
        for i, text in enumerate(texts):
            whole = f" {text}".encode()
            both = (self.tokenizers.encode_first(f" {text}"), second[i]) if text else ([], [])
            joined = (b"".join([side[t] for t in tokens]) for side, tokens in zip((self.tokenizers.first, self.tokenizers.second), both))
            if text and all(j == whole for j in joined):
                kept.append(i)
                ids[0].append(both[0])
                ids[1].append(both[1])
        stats: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        if not kept:
            return stats, np.empty(0, np.int64), np.empty(0, np.int64)
        counts = [np.array([len(t) for t in side], np.int64) for side in ids]
        a, b = (np.fromiter(chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip(ids, counts))
        ends_a, ends_b = np.cumsum(self.length[0][a]), np.cumsum(self.length[1][b])
        text_ends = ends_a[np.cumsum(counts[0]) - 1]
        at = np.searchsorted(ends_b, ends_a)
        cut_a = ends_b[at] == ends_a
        cuts = ends_a[cut_a]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        cut_b = cuts[group_b] == ends_b
        n_a, n_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        place_a = np.arange(len(a)) + np.concatenate(([0], n_b[:-1]))[group_a]
        place_b = np.arange(len(b)) + n_a[group_b]
        written_out = np.empty((len(a) + len(b), self.digits.shape[1]), np.uint8)
        written_out[place_a], written_out[place_b] = self.digits[a], self.digits[b]
        written_out[place_a, -1] = np.where(cut_a, ord("|"), ord(","))
        written_out[place_b, -1] = np.where(cut_b, ord(";"), ord(","))
        # The cuts of both sides together bound the overlaps, one per link.
        ends = np.union1d(ends_a, ends_b)
        owner = np.searchsorted(text_ends, ends)
        pairs = b[np.searchsorted(ends_b, ends)] << BITS | a[np.searchsorted(ends_a, ends)]
        links = np.bincount(owner, minlength=len(kept))
        groups = np.bincount(np.searchsorted(text_ends, cuts), minlength=len(kept))
        stop = np.cumsum(counts[0] + counts[1])
        start = stop - counts[0] - counts[1]
        for k, i in enumerate(kept):
            line = written_out[start[k] : stop[k]].tobytes().translate(None, b"\0")[:-1]
            stats[i] = (int(counts[0][k]), int(counts[1][k]), int(groups[k]), int(links[k]), hashlib.sha256(line).hexdigest())
        return stats, np.array(kept, np.int64)[owner], pairs


def pack(values: np.ndarray) -> bytes:
    """Integers >= 0 in as few bytes as the largest needs, equal bytes together, as zstd."""
    size = next(s for s in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * s)
    planes = values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(-1).astype(np.int64)


def pack_rising(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def _side_major(pairs: np.ndarray) -> np.ndarray:
    """The pairs with the radix of the second id in front, then the rest of it, then the
    first id: one sort brings radixes, second ids and pairs together."""
    b, a = pairs >> BITS, pairs & ((1 << BITS) - 1)
    return (b % RADIX) << (2 * BITS - 5) | (b // RADIX) << BITS | a


RUN_FIELDS = ("pairs", "counts", "holders", "places", "times")


def spill(pairs: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, dict[str, bytes]]]:
    """One sorted run of links, as a record per radix: the different pairs rising, how often
    each occurs, in how many texts, in which (rising within a pair), and how often there."""
    both = np.sort(_side_major(pairs) << BITS | places)
    first = np.flatnonzero(np.diff(both, prepend=-1))
    times = np.diff(first, append=len(both))
    record = both[first]
    pair, place = record >> BITS, record & ((1 << BITS) - 1)
    start = np.flatnonzero(np.diff(pair, prepend=-1))
    bounds = np.searchsorted(pair[start] >> (2 * BITS - 5), np.arange(RADIX + 1))
    start = np.append(start, len(record))
    for radix in range(RADIX):
        lo, hi = bounds[radix], bounds[radix + 1]
        if lo == hi:
            continue
        cut, own = start[lo : hi + 1], slice(start[lo], start[hi])
        holders = np.diff(cut)
        # Places rise within a pair; the first of a pair is kept as it is.
        steps = np.diff(place[own], prepend=0)
        heads = cut[:-1] - start[lo]
        steps[heads] = place[own][heads]
        yield (
            radix,
            {
                "pairs": pack_rising(pair[cut[:-1]]),
                "counts": pack(np.add.reduceat(times[own], heads)),
                "holders": pack(holders),
                "places": pack(steps),
                "times": pack(times[own] - 1),
            },
        )


def merge(runs: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs of (pair, count) as one, equal pairs summed. A heap has the last pair of the
    block each run is at. All that is not beyond the least of them is settled and goes out,
    the run whose block ends there takes its next, and no more is held than a block of each."""
    at = [0] * len(runs)
    heap = [(int(pairs[min(block, len(pairs)) - 1]), k) for k, (pairs, _) in enumerate(runs) if len(pairs)]
    heapq.heapify(heap)
    while heap:
        limit = heap[0][0]
        keys, counts = [], []
        for _, k in heap:
            pairs, number = runs[k]
            stop = at[k] + int(np.searchsorted(pairs[at[k] : at[k] + block], limit, side="right"))
            keys.append(pairs[at[k] : stop])
            counts.append(number[at[k] : stop])
            at[k] = stop
        while heap and heap[0][0] == limit:
            _, k = heapq.heappop(heap)
            pairs = runs[k][0]
            if at[k] < len(pairs):
                heapq.heappush(heap, (int(pairs[min(at[k] + block, len(pairs)) - 1]), k))
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[first], np.add.reduceat(count, first)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    runs = [
        (unpack_rising(p.as_py()), unpack(c.as_py())) for p, c in zip(table.column("pairs"), table.column("counts"))
    ]
    blocks = list(merge(runs))
    return np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])


def _encoded(docs: DataFrame, id_col: str, text_col: str, files: list[bytes]) -> DataFrame:
    """Rows of two kinds: per document its place in a run and its own figures; per run and
    radix its record. A task writes a run when it has enough links, so it never holds more
    than those of a run and of one text."""
    shared = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    schema = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("run", T.LongType()), T.StructField("place", T.IntegerType())]
        + [rows.schema["id"]]
        + [T.StructField(n, T.LongType()) for n in numbers]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("radix", T.IntegerType())]
        + [T.StructField(n, T.BinaryType()) for n in RUN_FIELDS]
    )
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, number = Aligner(*shared.value), TaskContext.get().partitionId() << 24
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        links = place = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if kept:
                for radix, record in spill(*(np.concatenate(x) for x in zip(*kept))):
                    row = {"kind": "run", "run": number, "radix": radix, **record}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row.get(n)], kinds[i]) for i, n in enumerate(names)], names=names
                    )

        kinds = None
        for batch in batches:
            if kinds is None:
                kinds = [pa.string(), pa.int64(), pa.int32(), batch.schema.field(0).type]
                kinds += [pa.int64()] * 4 + [pa.string(), pa.int32()] + [pa.binary()] * len(RUN_FIELDS)
            for start, stop in _parts(batch.column(1)):
                texts = [v.as_py() or "" for v in batch.column(1)[start:stop]]
                stats, owner, pairs = aligner.align(texts)
                n = len(texts)
                columns = {
                    "kind": pa.array(["doc"] * n), "run": pa.array(np.full(n, number)), "id": batch.column(0)[start:stop],
                    "place": pa.array(np.arange(place, place + n, dtype=np.int32)),
                    **{c: pa.array([s[k] for s in stats], pa.int64()) for k, c in enumerate(numbers)},
                    "groups_sha256": pa.array([s[4] for s in stats]),
                }
                yield pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kinds[i])) for i, c in enumerate(names)], names=names)
                kept.append((pairs, owner + place))
                links, place = links + len(pairs), place + n
                if links >= RUN_LINKS or place >= 1 << (BITS - 1):
                    yield from flush()
                    kept, links, place, number = [], 0, 0, number + 1
        yield from flush()

    return rows.mapInArrow(run, schema)


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PART_BYTES`` of text, each text whole."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text.as_buffer()) if text.is_valid else 0
        if size >= PART_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def align(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str = TOKENIZERS,
    first: str = FIRST,
    second: str = SECOND,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups_sha256``.

    A space and the text are cut into tokens by ``first`` (byte-level) and ``second`` (pieces).
    Tokens of both that overlap in bytes are linked. A pair of ids counts its links in all
    documents; a link is best if no pair of the same id of ``second`` counts more. Null and
    empty texts, and those whose tokens do not join to the same bytes, have no tokens: zeros
    and ''. Texts are encoded whole, however long. Repeated rows count each. Only id and text
    are read, so other columns do no harm. An empty table gives an empty one.

    1. Each task aligns its documents and spills sorted runs: a record of zstd blocks per
       radix of the second id, second id first, with the places of the texts.
    2. Runs of a radix are merged by a heap, ``FAN_IN`` or so at once, until one is left: the
       counts, in an order in which all pairs of a second id stand together, so the maximum
       of each is found on the way. Only pairs and counts move, not texts or places.
    3. Totals meet the runs by radix, and each run streams what its documents get: whether
       best, and the count. These are summed by document.

    A run has bounded size, totals of a radix are bounded by the vocabularies, and both sides
    of the join are dealt in copies, so no id holds up a task however frequent it is.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    files = [Path(folder, name).read_bytes() for name in (first, second)]
    path = f"{scratch.folder}/encoded"
    encoded = _encoded(docs, id_col, text_col, files)
    encoded.write.partitionBy("kind").parquet(path)
    whole = spark.read.schema(encoded.schema).parquet(path)
    documents = whole.where("kind = 'doc'").select("run", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    runs = whole.where("kind = 'run'").select("run", "radix", *RUN_FIELDS)

    left = runs.select("radix", "run", "pairs", "counts")
    number = runs.select("run").distinct().count()
    copies = max(1, ceil(number / RUNS_PER_COPY))

    def to_run(key: tuple, table: pa.Table) -> pa.Table:
        pairs, counts = _merged(table)
        return pa.table({"radix": [key[0].as_py()], "run": [key[1].as_py()], "pairs": [pack_rising(pairs)], "counts": [pack(counts)]}, schema=run_schema)

    def to_totals(key: tuple, table: pa.Table) -> pa.Table:
        pairs, counts = _merged(table)
        side = np.flatnonzero(np.diff(pairs >> BITS, prepend=-1))
        most = np.repeat(np.maximum.reduceat(counts, side), np.diff(side, append=len(pairs)))
        return pa.table({"radix": [key[0].as_py()], "pairs": [pack_rising(pairs)], "counts": [pack(counts)], "best": [pack((counts == most).astype(np.int64))]}, schema=total_schema)

    run_schema = pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])
    total_schema = pa.schema([("radix", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
    while number > FAN_IN:
        groups = ceil(number / (FAN_IN // 2))
        into = F.pmod(F.xxhash64("run"), F.lit(groups)).alias("run")
        before = left
        left = scratch.table(
            left.select("radix", into, "pairs", "counts").groupBy("radix", "run").applyInArrow(to_run, "radix int, run bigint, pairs binary, counts binary")
        )
        if scratch.owns(before):
            scratch.remove(before)
        number = groups
    totals = scratch.table(left.groupBy("radix").applyInArrow(to_totals, "radix int, pairs binary, counts binary, best binary"))
    copied = totals.select("radix", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.col("pairs").alias("all_pairs"), F.col("counts").alias("all_counts"), "best")
    met = runs.withColumn("copy", F.pmod(F.xxhash64("run"), F.lit(copies)).cast("int")).join(copied, ["radix", "copy"])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                run, pairs, holders, places, times, all_pairs, all_counts, best = (c[i].as_py() for c in batch.columns)
                at = np.searchsorted(unpack_rising(all_pairs), unpack_rising(pairs))
                holders, steps, times = unpack(holders), unpack(places), unpack(times) + 1
                heads = np.cumsum(holders) - holders
                # Places start anew with each pair.
                sums = np.cumsum(steps)
                place = sums - np.repeat(sums[heads] - steps[heads], holders)
                of = np.repeat(at, holders)
                size = int(place.max()) + 1
                n_best, count_sum, seen = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
                np.add.at(n_best, place, times * unpack(best)[of])
                np.add.at(count_sum, place, times * unpack(all_counts)[of])
                seen[place] = True
                own = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), run)), pa.array(own.astype(np.int32)), pa.array(n_best[own]), pa.array(count_sum[own])],
                    names=["run", "place", "n_best", "count_sum"],
                )

    given = met.select("run", "pairs", "holders", "places", "times", "all_pairs", "all_counts", "best").mapInArrow(
        give, "run bigint, place int, n_best bigint, count_sum bigint"
    )
    sums = scratch.table(given.groupBy("run", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    scratch.keep_only(sums)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return documents.join(sums, ["run", "place"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
