"""The Merkle manifest against a plain recursive version."""

from __future__ import annotations

import hashlib
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from corpora import frame, mixed_rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.llm.manifest import FIELDS, build, dataset_proofs, fold, leaf, roots, siblings  # noqa: E402
from tidemark.llm.queries import ORACLES  # noqa: E402


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, arity=8):
    """Root, and per leaf the (left, right) siblings from the leaf up."""
    level, spans, proofs = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        above, joined = [], []
        for start in range(0, len(level), arity):
            run = level[start : start + arity]
            for k in range(len(run)):
                for i in spans[start + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha(*run))
            joined.append([i for span in spans[start : start + arity] for i in span])
        level, spans = above, joined
    return level[0], proofs


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row, row["text"]), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, top = plain_tree([trees[g][0] for g in order])
    out = Counter()
    for g, above in zip(order, top):
        for (_, _, own, row), steps in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            out[(row["doc_id"], own, trees[g][0], root, tuple(steps + above))] += 1
    return out


def proofs_of(df):
    return Counter(
        (r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.steps)) for r in df.collect()
    )


@pytest.mark.parametrize("arity,stride", [(8, 2), (2, 3), (3, 1)])
def test_awkward_rows_equal_the_plain_version(spark, arity, stride, monkeypatch):
    docs = frame(spark, mixed_rows())
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "é").when(F.col("doc_id") % 3 == 1, "z").when(F.col("doc_id") == 2, ""))
    rows = [r.asDict() for r in docs.collect()]
    if arity == 8:
        assert proofs_of(dataset_proofs(docs)) == plain_manifest(rows)
        return
    monkeypatch.setitem(globals(), "plain_tree", lambda leaves, plain=plain_tree: plain(leaves, arity))
    assert proofs_of(dataset_proofs(docs, arity=arity, stride=stride)) == plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 8, 65, 513])
def test_sizes_around_whole_subtrees(spark, n):
    rows = spark.range(n).select(F.lit("g").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    levels = build(rows, "tree", ["id"])
    root, _ = plain_tree([hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)])
    assert [tuple(r) for r in roots(levels, "tree").collect()] == [("g", root)]
    # Level 0, and every second one above it.
    kept = {1: 1, 8: 2, 65: 3, 513: 3}[n]
    assert len(levels) == kept
    assert sum(t.count() for t in levels[1:]) == {1: 0, 8: 1, 65: 3, 513: 10}[n]


def test_fold_tells_changed_texts(spark):
    docs = spark.createDataFrame([(i, "Same Text" if i % 2 else "text", "en", None, 3) for i in range(70)], "doc_id long, text string, lang string, source string, n_chars long")
    claimed = leaf([F.lower("text") if c == "text" else F.col(c) for c in FIELDS])
    rows = dataset_proofs(docs, claimed=claimed).withColumn("folded", fold(F.col("claimed"), F.col("steps"))).collect()
    assert all((r.folded == r.root) == (r.doc_id % 2 == 0) for r in rows)
    assert len({r.root for r in rows}) == 1


def test_equal_rows_have_places_of_their_own(spark):
    docs = spark.createDataFrame([(1, "x", "en", "s", 1)] * 300 + [(None, None, None, None, None)] * 20, "doc_id long, text string, lang string, source string, n_chars long")
    got = proofs_of(dataset_proofs(docs))
    assert got == plain_manifest([r.asDict() for r in docs.collect()])
    assert len(got) == 320


def test_no_rows(spark):
    assert dataset_proofs(frame(spark, []).limit(0)).collect() == []


def test_empty_proof_of_a_single_row(spark):
    docs = frame(spark, [(5, "Alone", "s")])
    row = dataset_proofs(docs).withColumn("text", siblings(F.col("steps"))).first()
    assert row.leaf == row.subroot == row.root and row.text == "" and row.steps == []


def test_sql_is_given():
    assert "op11_merkle_manifest" in ORACLES
