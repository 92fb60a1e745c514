"""Rows repeated with one id and text cost the substring operator as one."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame  # noqa: E402

from tidemark.llm import substring_dedup  # noqa: E402


def test_repeated_rows_give_their_spans_once(spark):
    text = " ".join(f"w{i}" for i in range(200))
    part = " ".join(f"w{i}" for i in range(30, 110))
    rows = [(1, text, "a"), *[(2, "start " + part + " end", "a")] * 30, *[(3, text, "a")] * 30]
    spans = substring_dedup.repeats(frame(spark, rows)).collect()
    assert len(spans) == len(set(spans)) and {r.id for r in spans} == {2, 3}
    got = {(r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == {(1, 0), (2, 80), (3, 200)}


def test_extension_goes_both_ways_from_the_seed():
    from tidemark.llm.substring_dedup import extend

    words = b"a b c d e f g h i j".split()
    others = b"x b c d e f g h y j".split()
    assert extend(words, 3, others, 3, 2) == (1, 8)
    assert extend(words, 0, others, 1, 2) is None
    assert extend(words, 0, words, 0, 3) == (0, 10)
    assert extend(words, 8, b"i j".split(), 0, 2) == (8, 10)
