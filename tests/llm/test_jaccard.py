"""Near copies by Jaccard similarity against brute force."""

from __future__ import annotations

import itertools
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame, mixed_rows, words_of  # noqa: E402
from test_copies import components  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import jaccard  # noqa: E402
from tidemark.llm.common import Scratch  # noqa: E402
from tidemark.llm.simhash import near_pairs  # noqa: E402


def plain_shingles(text, size=5):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(text)]
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_rows(seed=5):
    """Texts of several lengths with copies of few to many changed words, and with one
    passage that very many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(30)]
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", "a"), (4, "ONE two", "a"), (None, "one two three", "a")]
    number = 10
    for length in (6, 20, 80, 81, 200, 632, 1632):
        base = [word() for _ in range(length)]
        for changed in (0, 1, 2, 3, 5, 9, 14, 20, 30, 45, 60):
            copy = list(base)
            for at in rng.sample(range(length), min(changed, length)):
                copy[at] = word()
            rows.append((number, " ".join(copy), "a"))
            number += 1
    for _ in range(60):
        own = [word() for _ in range(rng.randint(5, 120))]
        rows.append((number, " ".join(passage + own if number % 2 else own + passage), "b"))
        number += 1
    hot = [word() for _ in range(100)]
    for i in range(60):
        copy = list(hot)
        for at in rng.sample(range(100), i % 6):
            copy[at] = word()
        rows.append((number, " ".join(copy), "b"))
        number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [near_rows(), mixed_rows()], ids=["near", "mixed"])
def test_the_near_stage_keeps_one_row_of_each_component(spark, rows):
    sets = {t: plain_shingles(t) for _, t, _ in rows}
    nodes = list(set(sets.values()))
    number = {s: i for i, s in enumerate(nodes)}
    linked = [
        (number[a], number[b]) for a, b in itertools.combinations(nodes, 2) if plain_similarity(a, b) >= 0.8
    ]
    root = components(range(len(nodes)), linked)
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(root[number[sets[t]]], []).append((i is None, i or 0))
    want = sorted(min(members) for members in groups.values())
    docs = frame(spark, rows)
    out = corpus_pipeline.near(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == want
    assert len(linked) > 20


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_no_similar_pair_is_left_out(similarity):
    """Neither the prefixes, whatever is taken as common, nor the parities rule a pair out."""
    texts = [t for _, t, _ in near_rows(7)]
    sets = [s for s in map(jaccard.shingles, texts) if len(s)]
    rng = np.random.default_rng(1)
    common = np.unique(rng.choice(np.concatenate(sets), 400))
    times = rng.integers(3, 50, len(common))
    first = [set(jaccard.prefix(s, common, times, similarity)[0].tolist()) for s in sets]
    odd = [jaccard.parities(s) for s in sets]
    found = 0
    for x, y in itertools.combinations(range(len(sets)), 2):
        if jaccard.similar(sets[x], sets[y], similarity):
            found += 1
            assert first[x] & first[y]
            differ = sum(int(v).bit_count() for v in (odd[x] ^ odd[y]).view(np.uint64))
            assert differ <= len(np.setxor1d(sets[x], sets[y]))
    assert found


def test_no_rows(spark):
    docs = frame(spark, near_rows()).limit(0)
    assert jaccard.deduplicate(docs).collect() == []


def test_the_last_join_has_one_shingle_for_each_set_of_nodes(spark):
    """Texts 1 and 2 share shingles 10 to 19 and text 3 has 15 to 19 too: two sets of nodes."""
    rows = [(t, n, t - 10, 100, n) for n in (1, 2) for t in range(10, 20)] + [(t, 3, t - 15, 100, 3) for t in range(15, 20)]
    index = spark.createDataFrame(rows, "token long, node long, place int, n long, root long")
    kept = {(r.token, r.node) for r in jaccard._one_token_a_set(index).collect()}
    assert kept == {(10, 1), (10, 2), (15, 1), (15, 2), (15, 3)}


def test_fingerprints_find_the_first_links_without_pairing_copies(spark):
    """Forty nodes of one fingerprint and one two bits off: a pair with the least for each."""
    prints = spark.createDataFrame([(n, 7) for n in range(1, 41)] + [(50, 4), (60, -1)], "node long, fp long")
    pairs = [(r.a, r.b) for r in jaccard._fingerprint_pairs(prints, Scratch(spark)).collect()]
    assert sorted(set(pairs)) == [(1, n) for n in range(2, 41)] + [(1, 50)]
    assert len(pairs) == len(set(pairs))


def test_the_near_stage_uses_the_fingerprints(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jaccard, "near_pairs", lambda prints, *given: seen.append(prints) or near_pairs(prints, *given))
    docs = frame(spark, near_rows()[:40])
    corpus_pipeline.near(spark, docs, "").collect()
    assert len(seen) == 1 and seen[0].columns == ["fp"]


@pytest.mark.parametrize("similarity", [0.5, 0.8])
def test_places_leave_no_similar_pair_out(spark, similarity):
    """The first shingle that two similar texts share in their prefixes passes the places."""
    sets = [s for s in (jaccard.shingles(t) for _, t, _ in near_rows(11)) if len(s)]
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    first = [jaccard.prefix(s, *none, similarity)[0].tolist() for s in sets]
    rows = []
    for x, y in itertools.combinations(range(len(sets)), 2):
        if jaccard.similar(sets[x], sets[y], similarity):
            shared = next(t for t in first[x] if t in set(first[y]))
            rows.append((len(sets[x]), first[x].index(shared), len(sets[y]), first[y].index(shared)))
    pairs = spark.createDataFrame(rows, "n long, place int, m long, other int").selectExpr(
        "struct(n, place) as l", "struct(m as n, other as place) as r"
    )
    assert rows and pairs.where(jaccard._places_fit("l", "r", similarity)).count() == len(rows)
