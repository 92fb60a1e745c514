"""Toxicity: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch
from tidemark.llm.labelled import held_out, labelled_sample, one_each, with_labels

# Labelled documents of each class a model is fitted on, at most, of whatever length.
PER_CLASS = 1200
# Grades above 0, features kept, documents a feature must occur in, lengths of prefixes.
GRADES = 3
FEATURES = 3000
LEAST_DOCS = 4
PREFIXES = (4, 5, 6)
# A feature is evidence of toxicity if it is so many times as likely in toxic documents.
EVIDENCE = 8.0
STEPS, RATE, DECAY = 400, 0.05, 2e-4
# Words whose features a task remembers at once.
REMEMBERED = 500_000

# ASCII letters and all bytes beyond ASCII make up tokens.
_TOKEN = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def tokens(text: str | None) -> Counter[bytes]:
    """How often each lower-case token occurs in a text."""
    return Counter((text or "").lower().encode().translate(_TOKEN).split())


def features(words: Mapping[bytes, int]) -> Counter[bytes]:
    """Tokens and their first letters (marked by a hyphen), with counts. Stems that take
    endings or parts of compounds share a prefix."""
    out: Counter[bytes] = Counter()
    for word, times in words.items():
        for feature in features_of(word):
            out[feature] += times
    return out


def features_of(word: bytes) -> list[bytes]:
    return [word, *(word[:size] + b"-" for size in PREFIXES if len(word) >= size)]


@dataclass
class Model:
    """Shared weights of the features and the rising thresholds between the grades."""

    weights: dict[bytes, float]
    thresholds: np.ndarray
    _hits: dict[bytes, tuple[bytes, ...]] = field(default_factory=dict, repr=False, compare=False)

    def hits(self, word: bytes) -> tuple[bytes, ...]:
        """The features of a word that have a weight; most words have none."""
        found = self._hits.get(word)
        if found is None:
            if len(self._hits) >= REMEMBERED:
                self._hits.clear()
            found = self._hits[word] = tuple(f for f in features_of(word) if f in self.weights)
        return found

    def predictor(self, text: str | None) -> float:
        counts: dict[bytes, int] = {}
        for word, times in tokens(text).items():
            for feature in self.hits(word):
                counts[feature] = counts.get(feature, 0) + times
        return math.fsum(self.weights[f] * math.log1p(n) for f, n in counts.items())

    def at_least(self, predictors: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, one column each."""
        return _sigmoid(predictors[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _odds(bags: list[Counter[bytes]], toxic: np.ndarray) -> dict[bytes, tuple[int, float, float]]:
    """Of each feature in enough documents: documents, log odds and their z value."""
    inside = [Counter[bytes](), Counter[bytes]()]
    for bag, y in zip(bags, toxic):
        inside[int(y)].update(bag.keys())
    sizes = [(toxic == 0).sum() + 1.0, (toxic == 1).sum() + 1.0]
    out = {}
    for feature in inside[0].keys() | inside[1].keys():
        clean, bad = inside[0][feature], inside[1][feature]
        if clean + bad >= LEAST_DOCS:
            odds = np.log((bad + 0.5) / (sizes[1] - bad + 0.5)) - np.log((clean + 0.5) / (sizes[0] - clean + 0.5))
            error = np.sqrt(sum(1 / v for v in (bad + 0.5, sizes[1] - bad + 0.5, clean + 0.5, sizes[0] - clean + 0.5)))
            out[feature] = (clean + bad, float(odds), float(odds / error))
    return out


def grades_from_labels(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Severity grades for binary labels: 0 for clean documents; toxic ones are cut into equal
    parts by ``counts``, how many of their tokens are evidence."""
    cuts = np.quantile(counts[toxic == 1], np.arange(1, GRADES) / GRADES)
    return np.where(toxic == 1, 1 + (counts[:, None] > cuts).sum(axis=1), 0)


def fit(
    words: list[dict[bytes, int]],
    toxic: np.ndarray,
    totals: tuple[int, int],
    chosen: tuple[list[bytes], np.ndarray] | None = None,
) -> Model:
    """The model of token counts that are in memory already; ``train`` gives the same without
    bringing them there: it gives the ``chosen`` features and the evidence counts of documents,
    and of the documents these features' counts alone."""
    if len(np.unique(toxic)) < 2:
        return _unlearned(totals)
    if chosen is None:
        bags = [dict(sorted(features(bag).items())) for bag in words]
        odds = _odds(bags, toxic)
        evidence = {f for f, (_, o, z) in odds.items() if o >= math.log(EVIDENCE) and z > 3}
        counts = [sum(n for w, n in bag.items() if not evidence.isdisjoint(features_of(w))) for bag in words]
        kept = sorted(odds, key=lambda f: (-abs(odds[f][2]), f))[:FEATURES]
    else:
        bags, (kept, counts) = words, chosen
    number = {f: i for i, f in enumerate(kept)}
    row, column, value = [], [], []
    for i, bag in enumerate(bags):
        for feature, n in bag.items():
            if feature in number:
                row.append(i)
                column.append(number[feature])
                value.append(n)
    grade = grades_from_labels(np.array(counts, np.float64), toxic)
    return _descend(kept, grade, (np.array(row, int), np.array(column, int), np.log1p(np.array(value))))


def _unlearned(totals: tuple[int, int]) -> Model:
    """Without both classes nothing is learned and every text gets the share of toxic labels."""
    share = (totals[1] + 0.5) / (totals[0] + totals[1] + 1.0)
    return Model({}, np.log((1 - share) / share) + np.arange(GRADES, dtype=np.float64))


def _descend(kept: list[bytes], grade: np.ndarray, entries: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Model:
    """Weights by Adam on the likelihood of the grades; clean and toxic documents weigh alike.
    ``entries`` is the matrix: documents, features, values."""
    row, column, value = entries
    toxic = (grade > 0).astype(int)
    importance = np.where(toxic == 1, 0.5 / (toxic == 1).sum(), 0.5 / (toxic == 0).sum())
    p = {"w": np.zeros(len(kept)), "t": np.concatenate(([0.5], np.zeros(GRADES - 1)))}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    at = np.arange(len(grade))
    for step in range(1, STEPS + 1):
        steps_up = np.exp(p["t"][1:])
        thresholds = p["t"][0] + np.concatenate(([0.0], np.cumsum(steps_up)))
        eta = np.bincount(row, value * p["w"][column], len(grade))
        # P(grade >= k), from 1 for k = 0 to 0 beyond the last grade.
        reach = np.column_stack([np.ones(len(grade)), _sigmoid(eta[:, None] - thresholds), np.zeros(len(grade))])
        slope = reach * (1 - reach)
        likelihood = np.maximum(reach[at, grade] - reach[at, grade + 1], 1e-12)
        d_reach = np.zeros_like(reach)
        d_reach[at, grade] -= importance / likelihood
        d_reach[at, grade + 1] += importance / likelihood
        d = (d_reach * slope)[:, 1:-1]
        d_thresholds = -d.sum(axis=0)
        later = np.cumsum(d_thresholds[::-1])[::-1]
        gradient = {
            "w": np.bincount(column, value * d.sum(axis=1)[row], len(kept)) + DECAY * p["w"],
            "t": np.concatenate(([later[0]], later[1:] * steps_up)),
        }
        for k, g in gradient.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    thresholds = p["t"][0] + np.concatenate(([0.0], np.cumsum(np.exp(p["t"][1:]))))
    return Model({f: float(w) for f, w in zip(kept, p["w"])}, thresholds)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    per_class: int = PER_CLASS,
) -> Model:
    """The model of at most ``per_class`` labelled documents of each class outside the
    held-out quarter, whole texts; of several rows of an id one counts.

    The driver gets labels and evidence counts of these documents and the values of at most
    ``FEATURES`` features in them. Tokens are counted, and features chosen, in tasks, so the
    length of a document has no bound and nothing on the driver grows with it.
    """
    scratch = Scratch(docs.sparkSession)
    sample = labelled_sample(labels, label, per_class)
    text = with_labels(docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")), sample, "doc")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [tokens(v.as_py()) for v in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    pa.array([b" ".join(b) for b in bags], pa.binary()),
                    pa.array([np.fromiter(b.values(), np.int32, len(b)).tobytes() for b in bags], pa.binary()),
                ],
                names=["place", "content", "label", "total", "words", "times"],
            )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(2)[i].as_py().split()
                times = np.frombuffer(batch.column(3)[i].as_py(), np.int32)
                owner = pa.array(np.full(len(words), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(words, pa.binary()), pa.array(times)],
                    names=["place", "label", "word", "times"],
                )

    counted = text.select(F.md5(F.col("doc").cast("string")).alias("place"), F.xxhash64("text").alias("content"), "label", "total", "text").mapInArrow(
        count, "place string, content bigint, label int, total bigint, words binary, times binary"
    )
    chosen = scratch.table(one_each(counted))
    found = sorted(chosen.select("place", "label", "total").collect())
    totals = {r.label: r.total for r in found}
    toxic = np.array([r.label for r in found], int)
    both = totals.get(0, 0), totals.get(1, 0)
    if len(totals) < 2:
        scratch.keep_only()
        return _unlearned(both)
    words = chosen.select("place", "label", "words", "times").mapInArrow(
        unpack, "place string, label int, word binary, times int"
    )
    prefixes = [
        F.when(F.length("word") >= size, F.concat(F.substring("word", 1, size), F.lit(b"-"))) for size in PREFIXES
    ]
    named = words.withColumn("feature", F.explode(F.array_compact(F.array("word", *prefixes))))
    named = scratch.table(named)
    stats = scratch.table(_weighed(named, (toxic == 0).sum() + 1.0, (toxic == 1).sum() + 1.0))
    strongest = stats.orderBy(F.abs("z").desc(), "feature").limit(FEATURES)
    kept = [bytes(r.feature) for r in strongest.select("feature").collect()]
    spark = docs.sparkSession
    numbers = spark.createDataFrame(list(enumerate(kept)), "number int, feature binary")
    entries = (
        named.join(F.broadcast(numbers), "feature")
        .groupBy("place", "number")
        .agg(F.sum("times").alias("times"))
        .orderBy("place", "number")
        .toArrow()
    )
    evidence = stats.where((F.col("odds") >= math.log(EVIDENCE)) & (F.col("z") > 3)).select("feature")
    marks = (
        named.join(evidence, "feature", "left_semi")
        .groupBy("place", "word")
        .agg(F.first("times").alias("times"))
        .groupBy("place")
        .agg(F.sum("times").alias("times"))
    )
    marked = {r.place: r.times for r in marks.collect()}
    scratch.keep_only()
    at = {r.place: i for i, r in enumerate(found)}
    bags: list[dict[bytes, int]] = [{} for _ in found]
    for batch in entries.to_batches():
        for place, number, times in zip(*(column.to_pylist() for column in batch.columns)):
            bags[at[place]][kept[number]] = times
    return fit(bags, toxic, both, (kept, np.array([marked.get(r.place, 0) for r in found])))


def _weighed(named: DataFrame, clean: float, toxic: float) -> DataFrame:
    """Of each feature in enough documents its log odds and their z value, as ``_odds``."""
    seen = (
        named.select("feature", "place", "label")
        .distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("label").alias("bad"))
        .where(F.col("docs") >= LEAST_DOCS)
    )
    bad, good = F.col("bad"), F.col("docs") - F.col("bad")
    parts = [bad + 0.5, F.lit(float(toxic)) - bad + 0.5, good + 0.5, F.lit(float(clean)) - good + 0.5]
    odds = F.log(parts[0] / parts[1]) - F.log(parts[2] / parts[3])
    error = F.sqrt(sum((1 / p for p in parts[1:]), 1 / parts[0]))
    return seen.select("feature", odds.alias("odds"), (odds / error).alias("z"))


def predictor(model: Model) -> Callable[[Column], Column]:
    """A column function: the linear predictor of whole texts."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([model.predictor(text) for text in texts], dtype="float64")

    return of


def severities(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options: object
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``severity`` (expected grade, 0 to 3),
    ``grade`` (the most likely), ``toxic`` (grade 1 or more is likelier than 0), and
    ``p_1`` to ``p_3``, the probabilities of reaching each grade.

    All grades share one predictor, so the probabilities fall from grade to grade. Only the
    text enters; equal texts have equal rows. Null, blank and unknown texts have predictor 0.
    A null id is not held out. Without labels of both classes all rows are alike.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), predictor(model)(F.col(f"`{text_col}`")).alias("eta")
    )
    reach = [1 / (1 + F.exp(F.lit(float(t)) - F.col("eta"))) for t in model.thresholds]
    rows = rows.select("id", *(p.alias(f"p_{k}") for k, p in enumerate(reach, 1)))
    ladder = [F.lit(1.0), *(F.col(f"p_{k}") for k in range(1, GRADES + 1)), F.lit(0.0)]
    likely = F.array(*(a - b for a, b in zip(ladder, ladder[1:])))
    return rows.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        sum((F.col(f"p_{k}") for k in range(2, GRADES + 1)), F.col("p_1")).alias("severity"),
        (F.array_position(likely, F.array_max(likely)) - 1).cast("int").alias("grade"),
        (F.col("p_1") >= 0.5).alias("toxic"),
        *(f"p_{k}" for k in range(1, GRADES + 1)),
    )
