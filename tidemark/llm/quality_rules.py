"""Quality rules: text statistics and a learned decision list over them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACE_CHARS
from tidemark.llm.labelled import PER_CLASS, labelled_sample, one_each, with_labels

SYMBOLS = "#*$%&|<>"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_stress", "n_lines")
# What rules may ask for; each is a ratio of two statistics or one statistic.
MEASURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "upper_case": "n_upper / greatest(word_chars, 1)",
    "stress_per_word": "n_stress / greatest(n_words, 1)",
}
# A rule must be right about this share of the documents it rejects, in growing and pruning.
PRECISION = 0.95
LEAST_CAUGHT = 3
LONGEST_RULE = 3

Condition = tuple[str, str, float]  # measure, ">=" or "<", threshold
Rule = tuple[Condition, ...]


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    order = np.argsort(mixed, kind="stable")
    same = np.diff(mixed[order]) == 0
    if not same.any():
        return 0
    # Hashes only find the suspects; the words themselves decide.
    suspects = order[np.append(same, False) | np.append(False, same)]
    seen: dict[tuple[bytes, ...], int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for at in np.sort(suspects).tolist():
        before = seen.setdefault(tuple(words[at : at + window]), at)
        if before != at:
            for start in (before, at):
                covered[start] += 1
                covered[start + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The statistics of a whole text, in the order of STATISTICS; zeros for null."""
    text = text or ""
    data = text.encode()
    words = data.split()
    seen: set[str] = set()
    duplicates = lines = 0
    for line in text.split("\n"):
        if line.strip(SPACE_CHARS):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE_CHARS)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_words(words),
        len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        text.count("!") + text.count("?"),
        lines,
    )


def with_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", extra: Sequence[str] = ()) -> DataFrame:
    """Rows ``id``, the ``extra`` columns and the statistics, one for each row of ``docs``."""
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"), *(F.col(c) for c in extra), F.col(f"`{text_col}`").alias("text")
    )
    names = [*narrow.columns[:-1], *STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([statistics(v.as_py()) for v in batch.columns[-1]], np.int64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(column) for column in counts.T)], names=names
            )

    fields = [*narrow.schema.fields[:-1], *(T.StructField(s, T.LongType()) for s in STATISTICS)]
    return narrow.mapInArrow(run, T.StructType(fields))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _holds(x: dict[str, np.ndarray], rule: Sequence[Condition], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for measure, sign, threshold in rule:
        out &= x[measure] >= threshold if sign == ">=" else x[measure] < threshold
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the condition that gains most (in bits about the bad documents it keeps) until
    none of the good ones is left, or nothing is gained."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < LONGEST_RULE and (~bad[inside]).any():
        p0, n0 = bad[inside].sum(), inside.sum()
        best: tuple[float, Condition] | None = None
        for measure, values in x.items():
            v, y = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, caught = v[order], np.cumsum(y[order])
            cuts = np.flatnonzero(np.diff(v) > 0) + 1
            if not len(cuts):
                continue
            below, size = caught[cuts - 1], cuts
            for sign, p, n in (("<", below, size), (">=", p0 - below, n0 - size)):
                gain = p * (np.log2((p + 1e-9) / n) - np.log2((p0 + 1e-9) / n0))
                k = int(np.argmax(gain))
                if best is None or gain[k] > best[0] + 1e-12:
                    best = (gain[k], (measure, sign, float((v[cuts[k] - 1] + v[cuts[k]]) / 2)))
        if best is None or best[0] <= 0:
            break
        rule.append(best[1])
        inside &= _holds(x, rule[-1:], len(bad))
    return tuple(rule)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The leading part of a rule that is worth most on documents it wasn't grown on."""

    def worth(part: Rule) -> tuple[float, int]:
        inside = _holds(x, part, len(bad))
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return ((p - n) / (p + n) if p + n else -1.0, -len(part))

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds, prune it on the rest, keep it if it is
    precise on both, take out what it catches, and go on while bad documents are left."""
    n = len(bad)
    part = np.arange(n) % 3 == 2
    left = np.ones(n, bool)
    rules: list[Rule] = []
    while bad[left].any():
        grow, prune = left & ~part, left & part
        rule = _grow({m: v[grow] for m, v in x.items()}, bad[grow])
        rule = _prune(rule, {m: v[prune] for m, v in x.items()}, bad[prune])
        inside = left & _holds(x, rule, n)
        caught = bad[inside].sum()
        if not rule or caught < LEAST_CAUGHT or caught < PRECISION * inside.sum():
            break
        rules.append(rule)
        left &= ~inside
    return rules


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    per_class: int = PER_CLASS,
) -> list[Rule]:
    """Rules from at most ``per_class`` labelled documents of each class outside the held-out
    quarter that pass the base rules; of several rows of an id one counts. Only their
    statistics reach the driver."""
    sample = labelled_sample(labels, label, per_class)
    named = with_labels(docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")), sample, "doc")
    named = named.withColumn("content", F.xxhash64("text"))
    measured = (
        with_statistics(named, id_col="doc", extra=("content", "label"))
        .where(~base_failed())
        .select(F.md5(F.col("id").cast("string")).alias("place"), "content", "label", *(F.expr(m).alias(name) for name, m in MEASURES.items()))
    )
    rows = one_each(measured).collect()
    rows.sort(key=tuple)
    x = {m: np.array([r[m] for r in rows], np.float64) for m in MEASURES}
    return learn_rules(x, np.array([r["label"] == 0 for r in rows], bool))


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list as one conditional expression: the first rule that holds rejects."""
    signs = {">=": Column.__ge__, "<": Column.__lt__}
    decision = None
    for rule in rules:
        holds = reduce(Column.__and__, (signs[sign](F.expr(MEASURES[m]), F.lit(threshold)) for m, sign, threshold in rule))
        decision = F.when(holds, F.lit(False)) if decision is None else decision.when(holds, F.lit(False))
    return F.lit(True) if decision is None else decision.otherwise(F.lit(True))


def explain(rules: Sequence[Rule]) -> list[str]:
    """The decision list in words, one line a rule."""
    lines = ["reject if " + " and ".join(f"{m} {sign} {t:.4g}" for m, sign, t in rule) for rule in rules]
    return [*lines, "else keep"]


def judged(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options: object,
) -> DataFrame:
    """One row per row of ``docs``: id, the statistics, ``base_failed``, ``kept``.

    A document is kept if it passes the base rules and no learned rule rejects it. A null or
    blank text has zeros and fails the base; equal texts have equal verdicts. Without labels
    of both classes there are no rules and the base alone decides. A rule that would reject
    good documents as well is not taken, so what no rule describes is kept.
    """
    rules = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    rows = with_statistics(docs, id_col=id_col, text_col=text_col)
    return rows.select(
        F.col("id").alias(id_col),
        *STATISTICS,
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )
