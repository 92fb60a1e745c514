"""Mixing and packing: targets, positions, bins."""

from __future__ import annotations

import hashlib
import itertools
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame, mixed_rows, words_of  # noqa: E402

from tidemark.llm import mixing, packing  # noqa: E402

ROWS = mixed_rows()


def shared_targets(sizes, weights=(1, 2, 3), limit=3):
    """Reshares what exceeds the limits, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in stopped)
        open_weight = sum(weight[s] for s in order if s not in stopped)
        target = {s: limit * sizes[s] if s in stopped else rest * weight[s] / open_weight for s in order}
        over = {s for s in order if target[s] > limit * sizes[s] + 1e-9}
        if not over:
            return target
        stopped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing_round_by_round(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}é"[: rng.randint(2, 3)] + str(i): int(10 ** rng.uniform(0, 5)) for i in range(rng.randint(1, 25))}
    sizes[None] = rng.randint(0, 5000)
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = shared_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


def test_mix_equals_brute_force(spark):
    got = mixing.mix(frame(spark, ROWS)).collect()
    sizes, longest = Counter(), Counter()
    for _, t, s in ROWS:
        sizes[s] += len(words_of(t))
        longest[s] = max(longest[s], len(words_of(t)))
    target = shared_targets(dict(sizes))
    place = lambda row: (hashlib.md5(("" if row[0] is None else str(row[0])).encode()).hexdigest(), row[0] is not None, row[0] or 0)
    want = []
    for s in sizes:
        at, passes = 0, int(target[s] // sizes[s]) if sizes[s] else 0
        members = sorted((r for r in ROWS if r[2] == s), key=lambda r: (*place(r), len(words_of(r[1]))))
        for i, t, _ in members:
            n = len(words_of(t))
            copies = passes + (at + n / 2 <= target[s] - passes * sizes[s])
            at += n
            want.append((i, n, sizes[s], round(float(target[s]), 6), n * copies))
    assert sorted(repr((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken)) for r in got) == sorted(map(repr, want))
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size and len(r.positions) == r.copies and r.positions == sorted(r.positions)
        assert all(0 <= p <= 1 for p in r.positions)
        taken[r.source_size, r.target] += r.taken
    assert all(abs(taken[sizes[s], t] - t) <= longest[s] for s, t in target.items() if (sizes[s], t) in taken)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(frame(spark, ROWS[::-1]).repartition(7)).collect()))


def test_positions_follow_the_schedules(spark):
    """The share of a source's words before a time is the integral of its schedule."""
    rows = [(i, "w " * 10, f"s{i % 3}") for i in range(1500)]
    schedules = (((0.0, 2.0), (1.0, 0.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.0), (0.5, 1.0), (1.0, 4.0)))
    mixed = mixing.mix(frame(spark, rows), weights=(1.0,), schedules=schedules)
    by_source = defaultdict(list)
    for r in mixed.collect():
        by_source[r.doc_id % 3] += r.positions
    for source, schedule in enumerate(schedules):
        for time in (0.1, 0.3, 0.5, 0.8):
            want = 0.0
            for t0, t1, rate, slope, _, _ in mixing.segments(schedule):
                x = max(0.0, min(time, t1) - t0)
                want += rate * x + slope * x * x / 2
            share = sum(p <= time for p in by_source[source]) / len(by_source[source])
            assert abs(share - want) < 0.01
    order = mixing.training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and len(order) == 1500


@pytest.mark.parametrize("schedule", [((0.0, 1.0), (0.9, 1.0)), ((0.0, 0.0), (1.0, 0.0)), ((0.0, -1.0), (1.0, 2.0))])
def test_schedules_that_make_no_sense(schedule):
    with pytest.raises(ValueError):
        mixing.segments(schedule)


def test_take_repeats_rows_as_often_as_mixed(spark):
    docs = frame(spark, ROWS)
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id, r.content] = max(copies[r.doc_id, r.content], r.copies)
    rows = Counter((r.doc_id, r.text) for r in taken.collect())
    times = Counter((i, t) for i, t, _ in ROWS)
    assert sum(rows.values()) > 0
    assert sorted(n // times[k] for k, n in rows.items()) == sorted(n for n in copies.values() if n)


def check_bins(rows, capacity, per_source, sources):
    bins = defaultdict(list)
    for r in rows:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for members in bins.values():
        members.sort(key=lambda r: r.bin_offset)
        assert members[0].bin_offset == 0
        for a, b in itertools.pairwise(members):
            assert a.bin_offset + a.n_words == b.bin_offset
        assert members[-1].bin_offset + members[-1].n_words <= capacity
        assert len({r.cluster for r in members}) == len(members)
        if sources:
            assert max(Counter(sources[r.doc_id] for r in members).values()) <= per_source
    return bins


@pytest.mark.parametrize("shard_rows", [20_000, 9])
def test_every_word_is_packed_once(spark, shard_rows):
    rows = packing.pack(frame(spark, ROWS), capacity=300, per_source=2, shard_rows=shard_rows).collect()
    check_bins(rows, 300, 2, {})
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.cluster, r.copy].append((r.first_word, r.n_words))
    want = sorted(len(words_of(t)) for _, t, _ in ROWS)
    assert sorted(sum(n for _, n in pieces) for pieces in got.values()) == want
    for pieces in got.values():
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(pieces)) and pieces[0][0] == 0
    assert sum(r.bin_id is None for r in rows) == sum(not words_of(t) for _, t, _ in ROWS)


def test_sources_are_spread_over_bins(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i % 40 + 1)), "hot" if i % 3 else f"s{i % 4}") for i in range(400)]
    packed = packing.pack(frame(spark, rows), capacity=100, per_source=2).collect()
    bins = check_bins(packed, 100, 2, {i: s for i, _, s in rows})
    assert len({r.doc_id for r in packed}) == 400 and len(bins) < 400


def brute_pack(sizes, sources, clusters, capacity, per_source):
    bins = []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [
            b
            for b in bins
            if size < capacity and b["free"] >= size and b["sources"][source] < per_source and cluster not in b["clusters"]
        ]
        b = min(fits, key=lambda b: b["free"], default=None)
        if b is None:
            b = {"free": capacity, "sources": Counter(), "clusters": set()}
            bins.append(b)
        b["free"] -= size
        b["sources"][source] += 1
        b["clusters"] |= {cluster} - {-1}
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_the_tightest_bin_that_goes_with_a_document_is_found(seed):
    """Without conflicts the free spaces equal those of plain best fit; with them each choice
    is the tightest that brute force allows."""
    rng = random.Random(seed)
    n, capacity, per_source = 400, 100, rng.randint(1, 3)
    sizes = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
    sources = [rng.randrange(6) for _ in range(n)]
    clusters = [rng.choice([-1, -1, 0, rng.randrange(20)]) for _ in range(n)]
    bins, offsets = packing.pack_shard(sizes, sources, clusters, capacity, per_source)
    used, held, marks = Counter(), defaultdict(Counter), defaultdict(set)
    opened = 0
    for size, source, cluster, number, offset in zip(sizes, sources, clusters, bins, offsets):
        assert offset == used[number]
        fits = [
            capacity - used[b]
            for b in range(opened)
            if size < capacity and 0 < capacity - used[b] >= size and held[b][source] < per_source and cluster not in marks[b]
        ]
        assert (number == opened) if not fits else (number < opened and capacity - used[number] == min(fits))
        opened = max(opened, number + 1)
        used[number] += size
        held[number][source] += 1
        marks[number] |= {cluster} - {-1}
    free = packing.pack_shard(sizes, [0] * n, [-1] * n, capacity, n)
    plain = brute_pack(sizes, [0] * n, [-1] * n, capacity, n)
    left = Counter()
    for b, size in zip(free[0], sizes):
        left[b] += size
    assert sorted(left.values()) == sorted(capacity - b["free"] for b in plain)


def test_empty_tables(spark):
    docs = frame(spark, ROWS).limit(0)
    assert mixing.mix(docs).collect() == mixing.take(docs).collect() == packing.pack(docs).collect() == []
    assert mixing.training_order(mixing.mix(docs)).collect() == []
