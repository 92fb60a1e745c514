"""Scores of quality and toxicity against plain loops over every row, and the toxicity model
chosen in tasks against the one chosen in memory."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import quality_model, toxicity

SF_DIR = "/root/testdata/sf0.01"


def given(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def plain_tokens(text):
    """Runs of ASCII letters and bytes beyond ASCII, one byte at a time."""
    out, word = [], bytearray()
    for byte in (text or "").lower().encode() + b" ":
        if byte >= 128 or 97 <= byte <= 122:
            word.append(byte)
        elif word:
            out.append(bytes(word))
            word = bytearray()
    return out


def plain_counts(text):
    counts = Counter()
    for word in plain_tokens(text):
        counts[word] += 1
        for size in toxicity.PREFIXES:
            if len(word) >= size:
                counts[word[:size] + b"-"] += 1
    return counts


def test_severities_equal_plain_loops(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    model = toxicity.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.severities(docs, labels).collect()
    assert len(rows) == len(texts) == docs.count()
    for r in rows:
        eta = sum(model.weights.get(f, 0.0) * math.log(1 + n) for f, n in plain_counts(texts[r.doc_id]).items())
        p = [1 / (1 + math.exp(t - eta)) for t in model.thresholds]
        assert np.allclose([r.p_1, r.p_2, r.p_3], p, atol=1e-9)
        assert abs(r.severity - sum(p)) < 1e-9
        assert r.toxic == (p[0] >= 0.5)
        share = [1 - p[0], p[0] - p[1], p[1] - p[2], p[2]]
        assert share[r.grade] >= max(share) - 1e-9


def invented(spark):
    """Labelled texts of random words; toxic ones share a stem; one has 25,000 different words."""
    rng = random.Random(9)
    common = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows, known = [], []
    for i in range(240):
        words = rng.choices(common, k=rng.randint(0, 40))
        toxic = i % 3 == 0
        if toxic:
            words += [f"insult{rng.choice(['s', 'ing', 'ed', ''])}" for _ in range(rng.randint(1, 6))]
        if i == 3:
            words += ["w" + "".join("abcdefghij"[int(d)] for d in str(k)) for k in range(25_000)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        known.append((i, int(toxic)))
    rows += [(6, "another text of one id"), (None, "no id"), (1, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(known, "doc_id bigint, toxic int")


def test_features_chosen_in_tasks_equal_those_chosen_in_memory(spark):
    docs, labels = invented(spark)
    kept = {}
    hashed = docs.selectExpr("doc_id", "text", "xxhash64(text) AS content", "md5(CAST(doc_id AS string)) AS place").collect()
    toxic_of = {r.doc_id: r.toxic for r in labels.collect()}
    for r in hashed:
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            if r.place not in kept or r.content < kept[r.place].content:
                kept[r.place] = r
    rows = [kept[place] for place in sorted(kept)]
    assert max(len(set(plain_tokens(r.text))) for r in rows) > 25_000
    toxic = np.array([toxic_of[r.doc_id] for r in rows])
    expected = toxicity.fit([Counter(plain_tokens(r.text)) for r in rows], toxic, (1, 1))
    model = toxicity.train(docs, labels)
    assert model.weights.keys() == expected.weights.keys()
    assert np.allclose([model.weights[f] for f in expected.weights], list(expected.weights.values()), atol=1e-5)
    assert np.allclose(model.thresholds, expected.thresholds, atol=1e-5)
    assert b"insult-" in model.weights


def test_words_are_forgotten_and_scored_alike(monkeypatch):
    model = toxicity.Model({b"bad": 2.0, b"insu-": 1.0}, np.array([0.5, 1.0, 1.5]))
    texts = ["bad insult insults good", "", None, "BAD bad, insulting"]
    scores = [model.predictor(t) for t in texts]
    assert scores == pytest.approx([2 * math.log(2) + math.log(3), 0, 0, 2 * math.log(3) + math.log(2)])
    monkeypatch.setattr(toxicity, "REMEMBERED", 1)
    model = toxicity.Model(model.weights, model.thresholds)
    assert [model.predictor(t) for t in texts] == scores and len(model._hits) <= 1


KINDS = ["#*$%&|<>@^~=_+\\/{}[]", "!?", ".,;:'\"()-", "0123456789"]


def plain_passages(text):
    words = (text or "").encode().split()
    if not words:
        return [[0.0] * 15]
    seen, out, row = set(), [], []
    for i, word in enumerate(words):
        triple = tuple(words[i : i + 3])
        fresh = len(triple) < 3 or triple not in seen
        seen.add(triple)
        row.append((word, i + 1 < len(words) and words[i + 1] == word, fresh))
        if len(row) == 64 or i + 1 == len(words):
            kinds = [0] * 7
            for byte in b"".join(w for w, _, _ in row):
                for k, chars in enumerate(KINDS):
                    kinds[k] += byte < 128 and chr(byte) in chars
                kinds[4] += 65 <= byte <= 90
                kinds[5] += 97 <= byte <= 122
                kinds[6] += byte >= 128
            n, size = len(row), sum(len(w) for w, _, _ in row)
            mean = size / n
            spread = math.sqrt(max(sum(len(w) ** 2 for w, _, _ in row) / n - mean**2, 0))
            out.append(
                [k / size for k in kinds]
                + [k / n for k in kinds[:3]]
                + [mean / 10, spread / 10, len({w for w, _, _ in row}) / n]
                + [sum(a for _, a, _ in row) / n, sum(f for _, _, f in row) / n]
            )
            row = []
    return out


def plain_score(text, model):
    p = model.layers
    encoded, gates = [], []
    for row in plain_passages(text):
        x = [(v - m) / s for v, m, s in zip(row, model.mean, model.scale)]
        h = [math.tanh(sum(a * w for a, w in zip(x, column)) + b) for column, b in zip(p["W"].T, p["wb"])]
        encoded.append(h)
        gate = 0.0
        for v, u, a in zip(p["V"].T, p["U"].T, p["a"]):
            t = math.tanh(sum(q * w for q, w in zip(h, v)))
            gate += a * t / (1 + math.exp(-sum(q * w for q, w in zip(h, u))))
        gates.append(math.exp(gate))
    pooled = [sum(g * h[j] for g, h in zip(gates, encoded)) / sum(gates) for j in range(len(encoded[0]))]
    logit = sum(z * c for z, c in zip(pooled, p["c"])) + p["cb"][0] + model.shift
    return 1 / (1 + math.exp(-max(-60, min(60, logit))))


def test_quality_scores_equal_plain_loops(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    model = quality_model.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality_model.quality_scores(docs, labels).collect()
    assert len(rows) == len(texts)
    assert max(abs(r.score - plain_score(texts[r.doc_id], model)) for r in rows) < 1e-3
    assert sum(r.score >= 0.7 for r in rows) == sum(r.predicted for r in rows)
