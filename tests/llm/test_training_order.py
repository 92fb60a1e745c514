"""The copies that the pipeline's mixing stage hands on stand in the order of training."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import mixing  # noqa: E402


def test_copies_are_written_by_position(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(5 + i % 40)), "abc"[0 if i % 2 else 1 if i % 10 else 2]) for i in range(300)]
    docs = frame(spark, rows)
    want = [r.doc_id for r in mixing.training_order(mixing.mix(docs)).collect()]
    assert [r.doc_id for r in corpus_pipeline.mixed(spark, docs, "").collect()] == want
    assert len(want) > len(set(want)) and want != sorted(want)
