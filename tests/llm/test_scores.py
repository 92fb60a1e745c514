"""Quality model, quality rules and toxicity: statistics, held-out accuracy, edge cases."""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame, mixed_rows, words_of  # noqa: E402

from tidemark.llm import labelled, quality_model, quality_rules, toxicity  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
ROWS = mixed_rows()
LABELS = "doc_id bigint, quality int, toxic int, label string, text string"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, t, "x", "y") for i, q, t in rows], LABELS)


def given(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def some_labels(spark):
    rows = [(i, int(i % 4 > 0), int(i % 3 == 0)) for i, _, _ in ROWS if i is not None]
    return labels(spark, [*rows, (None, 1, 1), (10, None, None), (77777, 0, 1), (20, 0, 0)])


def test_sample_is_bounded_and_leaves_the_held_out_rows_alone(spark):
    picked = labelled.labelled_sample(some_labels(spark), "quality", per_class=5).collect()
    assert Counter(r.label for r in picked) == {0: 5, 1: 5}
    assert all(zlib.crc32(str(r.sample_id).encode()) % 4 != 2 for r in picked)


def brute_statistics(text):
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None, "", " \t\x0b", "a", "a a a a a", "a a a a a a", "x\nx\nx y\n\n\nx", "#a $b <c>|& *%", "é è ê\x1cü", "b c d e f " * 3,
    "one two three four five six one two three four five", "\r\nsame \r\nsame \r\n", "ends\n", "!!! ??? A\x85B",
]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_equal_brute_force(text):
    assert quality_rules.statistics(text)[:5] == brute_statistics(text)


def test_statistics_of_random_texts():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("ab \n#é") for _ in range(rng.randint(0, 120)))
        assert quality_rules.statistics(text)[:5] == brute_statistics(text)


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(quality_rules, "hash", lambda word: 1, raising=False)
    words = "a b c d e f g h i j".encode().split()
    assert quality_rules.repeated_words(words) == 0
    assert quality_rules.repeated_words(words + words[:5]) == 10


def test_decision_list_learns_a_conjunction_and_keeps_what_no_rule_describes():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(900), "b": rng.random(900), "c": rng.random(900)}
    bad = (x["a"] > 0.6) & (x["b"] < 0.4)
    rules = quality_rules.learn_rules(x, bad)
    caught = np.zeros(900, bool)
    for rule in rules:
        caught |= quality_rules._holds(x, rule, 900)
    assert (caught == bad).mean() > 0.97
    assert quality_rules.learn_rules(x, np.zeros(900, bool)) == []
    assert quality_rules.learn_rules(x, rng.random(900) < 0.3) == []


def test_rules_on_the_given_labels(spark):
    rows = quality_rules.judged(given(spark, "documents"), given(spark, "labels")).join(given(spark, "labels"), "doc_id").collect()
    long = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept == (r.quality == 1) for r in long]) > 0.97
    assert all(r.kept for r in long if r.quality == 1)


def test_quality_on_held_out_labels(spark):
    rows = quality_model.quality_scores(given(spark, "documents"), given(spark, "labels")).join(given(spark, "labels"), "doc_id").collect()
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 50
    assert np.mean([r.predicted == r.quality for r in unseen]) > 0.97


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, known = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.severities(docs, known).withColumnRenamed("toxic", "found").join(known, "doc_id").where("held_out").collect()
    assert np.mean([r.found for r in rows if r.toxic == 1]) > 0.9
    assert np.mean([r.found for r in rows if r.toxic == 0]) < 0.03
    assert all(r.p_1 >= r.p_2 >= r.p_3 and abs(r.severity - r.p_1 - r.p_2 - r.p_3) < 1e-9 for r in rows)


def test_ordinal_grades_order_the_severity():
    rng = random.Random(2)
    bags, toxic = [], []
    for i in range(400):
        bag = Counter(rng.choice([b"plain", b"words", b"here", b"more"]) for _ in range(30))
        if i % 2:
            bag[b"insult"] = 1 + i % 9
        bags.append(bag)
        toxic.append(i % 2)
    model = toxicity.fit(bags, np.array(toxic), (200, 200))
    expected = [
        float(model.at_least(np.array([model.predictor("plain words " + "insult " * n)])).sum()) for n in (0, 1, 3, 9)
    ]
    assert expected == sorted(expected) and expected[0] < 0.3 and expected[-1] > 2
    assert (np.diff(model.thresholds) > 0).all()


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(3)
    bags, y = [], []
    for i in range(300):
        bag = rng.normal(0, 0.1, (rng.integers(1, 12), quality_model.N_FEATURES)).astype(np.float32)
        if i % 3 == 0:
            bag[rng.integers(len(bag)), 0] = 3.0
        bags.append(bag)
        y.append(float(i % 3 != 0))
    model = quality_model.fit(bags, np.array(y), (100, 200))
    starts = np.cumsum([0, *(len(b) for b in bags)])[:-1]
    assert np.mean((model.logits(np.concatenate(bags), starts) > 0) == (np.array(y) == 1)) > 0.95


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(4)
    shapes = {"W": (15, 12), "wb": (12,), "V": (12, 8), "U": (12, 8), "a": (8,), "c": (12,), "cb": (1,)}
    p = {k: rng.normal(0, 0.5, s) for k, s in shapes.items()}
    x, starts, y, w = rng.normal(0, 1, (20, 15)), np.array([0, 3, 9]), np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss(p):
        q = quality_model._sigmoid(quality_model._forward(p, x, starts)["logit"])
        return -(w * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() / w.sum()

    for name, d in quality_model._gradients(p, x, starts, y, w).items():
        at = tuple(rng.integers(n) for n in p[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - d[at]) < 1e-6


@pytest.mark.parametrize("kind", ["none", "one class", "some"])
def test_scores_of_awkward_rows(spark, kind):
    known = {
        "none": labels(spark, []),
        "one class": labels(spark, [(10, 1, 0), (11, 1, 0)]),
        "some": some_labels(spark),
    }[kind]
    docs = frame(spark, ROWS)
    for result in (
        quality_model.quality_scores(docs, known),
        quality_rules.judged(docs, known),
        toxicity.severities(docs, known),
    ):
        rows = result.collect()
        assert sorted(repr(r.doc_id) for r in rows) == sorted(repr(i) for i, _, _ in ROWS)
        assert all(v is not None for r in rows for k, v in r.asDict().items() if k != "doc_id")
        assert result.where(F.lit(False)).collect() == []
    scores = quality_model.quality_scores(docs, known).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scores)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scores)
    kept = quality_model.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in scores if r.predicted)


def test_scores_of_an_empty_table(spark):
    docs, known = frame(spark, ROWS).limit(0), some_labels(spark)
    assert quality_model.quality_scores(docs, known).collect() == []
    assert quality_model.keep_good(docs, known).collect() == []
    assert quality_rules.judged(docs, known).collect() == []
    assert toxicity.severities(docs, known).collect() == []
