"""The near stage takes the links of op1 as well as those by Jaccard similarity."""

from __future__ import annotations

import itertools
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame  # noqa: E402
from test_copies import components, plain_fingerprint  # noqa: E402
from test_jaccard import plain_shingles, plain_similarity  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import jaccard  # noqa: E402


def edited_rows(seed=4):
    """Texts with copies of few changed words, phrases said over and over before an own end,
    blank texts, ids that are null or repeat, and rows that repeat."""
    rng = random.Random(seed)
    words = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    rows = [(900, None, "a"), (901, "", "a"), (902, " \n", "a"), (None, " ".join(words(50)), "a")]
    number = 10
    for _ in range(30):
        base = words(rng.randint(60, 140))
        for changed in (0, 1, 2, 3, 4):
            copy = list(base)
            for at in rng.sample(range(len(base)), changed):
                copy[at] = words(1)[0]
            rows.append((number, " ".join(copy), "b"))
            number += 1
    phrase = words(11)
    for _ in range(3):
        said = " ".join(phrase * 40 + words(15))
        rows += [(number, said, "c"), (number + 1, said.replace("a", "A", 1) + " more", "c")]
        number += 2
    rows += [(None, rows[-1][1] + " once", "c"), (10, "another text of this id", "b"), rows[5], rows[5]]
    rng.shuffle(rows)
    return rows


def links_of(rows):
    """Distinct texts and the pairs of them that op1 links, and that are similar."""
    texts = list(dict.fromkeys(t for _, t, _ in rows))
    prints, sets = [plain_fingerprint(t) for t in texts], [plain_shingles(t) for t in texts]
    pairs = list(itertools.combinations(range(len(texts)), 2))
    by_print = {(x, y) for x, y in pairs if (prints[x] ^ prints[y]).bit_count() <= 4}
    return texts, by_print, {(x, y) for x, y in pairs if plain_similarity(sets[x], sets[y]) >= 0.8}


def least_ids(rows, texts, linked):
    root = components(range(len(texts)), list(linked))
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(root[texts.index(t)], []).append((i is None, i or 0))
    return sorted(min(members) for members in groups.values())


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


def test_the_near_stage_leaves_out_no_link_of_op1_or_of_similarity(spark):
    rows = edited_rows()
    texts, by_print, alike = links_of(rows)
    assert len(by_print - alike) > 5 and len(alike - by_print) > 5
    want = least_ids(rows, texts, by_print | alike)
    assert len(want) < min(len(least_ids(rows, texts, some)) for some in (by_print, alike))
    docs = frame(spark, rows)
    out = corpus_pipeline.near(spark, docs, "")
    assert out.columns == docs.columns
    assert ids(out) == want


@pytest.mark.parametrize("numbers", [(5, 7, 9), (9, 7, 5), (9, 5, 7)])
def test_a_component_may_hold_links_of_both_kinds(spark, numbers):
    """The second text is linked with the first by op1 alone, with the third by similarity alone."""
    rng = random.Random(1)
    words = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    phrase, end = words(11), words(60)
    texts = [" ".join(w) for w in (phrase * 40 + words(60), phrase * 40 + end, phrase * 2 + end + ["more"])]
    rows = [(i, t, "a") for i, t in zip(numbers, texts)]
    assert links_of(rows)[1:] == ({(0, 1)}, {(1, 2)})
    assert ids(corpus_pipeline.near(spark, frame(spark, rows), "")) == [(False, 5)]


def test_without_fingerprints_similar_texts_alone_are_linked(spark):
    rows = edited_rows()
    texts, _, alike = links_of(rows)
    assert ids(jaccard.deduplicate(frame(spark, rows))) == least_ids(rows, texts, alike)
