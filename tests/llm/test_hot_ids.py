"""Ids that many rows share: they weigh in a fit, and cost the driver, as one row."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import quality_model, quality_rules, toxicity


def tables(spark, hot):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(rng.randint(20, 90)))) for i in range(80)]
    kept = [row for row in rows for _ in range(hot if row[0] in (1, 2, 4) else 1)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    return spark.createDataFrame(kept, "doc_id bigint, text string").repartition(3), labels


@pytest.mark.parametrize(
    "module, name", [(quality_model, "fit"), (quality_rules, "learn_rules"), (toxicity, "fit")], ids=["op2", "op7", "op10"]
)
def test_repeated_rows_do_not_change_what_is_learned_from(spark, monkeypatch, module, name):
    given = []
    fit = getattr(module, name)
    monkeypatch.setattr(module, name, lambda *args: given.append(args) or fit(*args))
    for hot in (1, 40):
        module.train(*tables(spark, hot))
    once, often = given
    size = lambda args: len(args[1])
    assert size(once) == size(often) <= 80
    if module is quality_rules:
        assert all(np.array_equal(once[0][m], often[0][m]) for m in once[0])
    elif module is quality_model:
        assert all(np.array_equal(a, b) for a, b in zip(once[0], often[0]))
    else:
        assert once[0] == often[0]
    assert np.array_equal(once[1], often[1])


def test_long_documents_are_condensed_not_left_out():
    import numpy as np

    from tidemark.llm.quality_model import _condensed

    rows = np.arange(3000, dtype=np.float32).reshape(1000, 3)
    few = _condensed(rows, 7)
    assert few.shape == (7, 3) and few.dtype == rows.dtype and (np.diff(few[:, 0]) > 0).all()
    sizes = np.diff([*(np.arange(7) * 1000 // 7), 1000])
    assert np.allclose((few * sizes[:, None]).sum(axis=0), rows.sum(axis=0), rtol=1e-5)
    assert _condensed(rows, 1000) is rows
