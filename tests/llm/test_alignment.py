"""Tokenizer alignment against a plain version that looks at every pair of tokens."""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame, mixed_rows  # noqa: E402

from tidemark.llm import alignment  # noqa: E402
from tidemark.llm.common import table  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "  two  spaces ", "a", "<|endoftext|> and </s> <s><unk>", "▁ low line", "tab\tand\nline\r\n",
    "é" * 40, "日本語のテキスト", "😀 😀😀", "x\0y", "   odd spaces", "é composed", "It's we'll I'M",
    " " * 9000 + "end", "1234567890 " * 30, "aaaa" * 3000, "﻿mark", "<0x0A> literal", "ﬁ ligature Ａ wide",
]


@pytest.fixture(scope="module")
def plain():
    first = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.FIRST}")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.SECOND}")
    byte_of = {c: b for c, b in alignment._byte_of().items()}

    def spans(text):
        """Per side (id, start, end) in bytes; None if they do not join to the text."""
        a = first.encode(f" {text}", add_special_tokens=False).ids
        b = second.encode(text)
        of_a = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a]
        of_b = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if b"".join(of_a) != f" {text}".encode() or b"".join(of_b) != f" {text}".encode():
            return None
        out = []
        for ids, parts in ((a, of_a), (b, of_b)):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            out.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends)])
        return out

    return spans


def expected(rows, spans):
    """Every row as (id, figures, digest)."""
    found, counts = [], Counter()
    for doc_id, text in rows:
        sides = spans(text) if text else None
        links = []
        if sides:
            links = [(x[0], y[0]) for x in sides[0] for y in sides[1] if x[1] < y[2] and y[1] < x[2]] if len(text) < 3000 else _swept(*sides)
        counts.update(links)
        found.append((doc_id, sides, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = Counter()
    for doc_id, sides, links in found:
        if not sides:
            out[(doc_id, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        cuts = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
        groups, start = [], 0
        for cut in cuts:
            part = lambda side: ",".join(str(i) for i, s, e in side if start <= s and e <= cut)  # noqa: B023, E731
            groups.append(f"{part(sides[0])}|{part(sides[1])}")
            start = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out[(doc_id, len(sides[0]), len(sides[1]), len(groups), len(links),
             sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest)] += 1
    return out


def _swept(a, b):
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i][0], b[j][0]))
        end_a, end_b = a[i][2], b[j][2]
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
    return links


def result(df):
    return Counter(
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()
    )


def short(rows):
    return [(i, t) for i, t in rows if t is None or len(t) < 20_000]


def test_awkward_texts(spark, plain):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [r for r in mixed_rows() if len(r[1] or "") < 4000]
    assert result(alignment.align(frame(spark, rows))) == expected([(r[0], r[1]) for r in rows], plain)


def test_many_small_runs_and_merges(spark, plain, monkeypatch):
    # The values reach the tasks inside the functions that are sent to them.
    rows = [(i, f"text {i % 7} of some words and {i}", "s") for i in range(60)]
    want = expected([(r[0], r[1]) for r in rows], plain)
    monkeypatch.setattr(alignment, "FAN_IN", 4)
    monkeypatch.setattr(alignment, "RUNS_PER_COPY", 2)
    docs = frame(spark, rows).repartition(8)
    assert result(alignment.align(docs)) == want


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")
def test_documents(spark, plain):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = short(rows)
    ids = [i for i, _ in kept]
    assert result(alignment.align(docs.where(docs.doc_id.isin(ids)))) == expected(kept, plain)


def test_no_rows(spark):
    assert alignment.align(frame(spark, []).limit(0)).collect() == []


def test_both_libraries_agree():
    files = [Path(alignment.TOKENIZERS, n).read_bytes() for n in (alignment.FIRST, alignment.SECOND)]
    both = alignment.Tokenizers(*files)
    assert both.fast is not None
    for text in [t for t in TEXTS if t] + [t for _, t, _ in mixed_rows() if t]:
        assert both.encode_first(f" {text}") == both.slow.encode(f" {text}", add_special_tokens=False).ids


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_merge_equals_a_counter(block):
    rng = np.random.default_rng(4)
    runs, want = [], Counter()
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 200, rng.integers(0, 120)))
        counts = rng.integers(1, 9, len(pairs))
        runs.append((pairs, counts))
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
    got = [x for keys, counts in alignment.merge(runs, block) for x in zip(keys.tolist(), counts.tolist())]
    assert got == sorted(want.items())


@pytest.mark.parametrize("values", [[], [0], [255, 0], [256, 1], [2**33, 5], [2**60]])
def test_packing_round_trip(values):
    array = np.array(values, np.int64)
    assert alignment.unpack(alignment.pack(array)).tolist() == values
    assert alignment.unpack_rising(alignment.pack_rising(np.sort(array))).tolist() == sorted(values)


def test_spilled_runs_hold_all_links():
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 100, 5000) << alignment.BITS | rng.integers(0, 50, 5000)
    places = rng.integers(0, 40, 5000)
    total = Counter()
    for radix, record in alignment.spill(pairs, places):
        keys, counts = alignment.unpack_rising(record["pairs"]), alignment.unpack(record["counts"])
        assert (np.diff(keys) > 0).all() and set((keys >> (2 * alignment.BITS - 5)).tolist()) == {radix}
        total.update(dict(zip(keys.tolist(), counts.tolist())))
    assert total == Counter(alignment._side_major(pairs).tolist())
