"""Quality classifier: attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import PER_CLASS, held_out, labelled_sample, one_each, with_labels

PASSAGE_WORDS = 64
THRESHOLD = 0.7
# Rows that a document is learned from, at most: of more passages, neighbours are averaged, so
# all of the text counts and what reaches the driver is bounded. Scores use every passage.
LEARN_PASSAGES = 256
HIDDEN, GATE = 12, 8
STEPS, RATE, DECAY = 250, 0.03, 1e-4

# Kinds of bytes whose shares describe a passage.
KINDS = {"symbol": b"#*$%&|<>@^~=_+\\/{}[]", "stress": b"!?", "mark": b".,;:'\"()-", "digit": b"0123456789"}
_KIND = np.zeros(256, np.uint8)  # 0: anything else
for _n, _bytes in enumerate(KINDS.values(), 1):
    _KIND[list(_bytes)] = _n
_KIND[65:91], _KIND[97:123], _KIND[128:] = 5, 6, 7
N_KINDS = 8
N_FEATURES = 15
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def passages(text: str | None) -> np.ndarray:
    """One row of features per passage of 64 words, from the text alone: shares of kinds of
    bytes, word lengths, and how far words and word triples repeat in the passage and before
    it. A null, empty or blank text has one row of zeros."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return np.zeros((1, N_FEATURES), np.float32)
    at = np.arange(0, n, PASSAGE_WORDS)
    counts = np.diff(np.append(at, n)).astype(np.float64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    bytes_in = np.add.reduceat(lengths, at)
    kind = _KIND[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(at)), bytes_in)
    kinds = np.bincount(owner * N_KINDS + kind, minlength=len(at) * N_KINDS).reshape(-1, N_KINDS)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    passage = np.arange(n) // PASSAGE_WORDS

    def fresh(values: np.ndarray) -> np.ndarray:
        """1 for the first of equal values, else 0."""
        out = np.zeros(len(values))
        out[np.unique(values, return_index=True)[1]] = 1
        return out

    inside = np.add.reduceat(fresh(hashes + passage.astype(np.uint64) * _MIX[0]), at) / counts
    again = np.append(hashes[1:] == hashes[:-1], False).astype(np.float64)
    triple = np.ones(n)
    if n > 2:
        triple[:-2] = fresh(hashes[:-2] * _MIX[0] + hashes[1:-1] * _MIX[1] + hashes[2:] * _MIX[2])
    per_byte, per_word = np.maximum(bytes_in, 1)[:, None], counts[:, None]
    mean = bytes_in / counts
    spread = np.sqrt(np.maximum(np.add.reduceat(lengths**2, at) / counts - mean**2, 0))
    return np.column_stack(
        [
            kinds[:, 1:8] / per_byte,
            kinds[:, 1:4] / per_word,
            mean / 10,
            spread / 10,
            inside,
            np.add.reduceat(again, at) / counts,
            np.add.reduceat(triple, at) / counts,
        ]
    ).astype(np.float32)


@dataclass
class Weights:
    """Scaling, passage encoder, gated attention and output of the model."""

    mean: np.ndarray
    scale: np.ndarray
    layers: dict[str, np.ndarray]
    shift: float = 0.0

    def logits(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _forward(self.layers, (rows - self.mean) / self.scale, starts)["logit"] + self.shift


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """x: passages of all documents, those of a document from each of ``starts``."""
    h = np.tanh(x @ p["W"] + p["wb"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["a"]
    sizes = np.diff(np.append(starts, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(weight[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "sizes": sizes, "logit": z @ p["c"] + p["cb"][0]}


def _gradients(p, x, starts, y, importance):
    f = _forward(p, x, starts)
    d_logit = (_sigmoid(f["logit"]) - y) * importance / importance.sum()
    d_z = np.repeat(d_logit[:, None] * p["c"], f["sizes"], axis=0)
    gain = (d_z * f["h"]).sum(axis=1)
    d_e = f["weight"] * (gain - np.repeat(np.add.reduceat(f["weight"] * gain, starts), f["sizes"]))
    d_tg = d_e[:, None] * p["a"]
    d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
    d_h = f["weight"][:, None] * d_z + d_t @ p["V"].T + d_g @ p["U"].T
    d_in = d_h * (1 - f["h"] ** 2)
    return {
        "W": x.T @ d_in,
        "wb": d_in.sum(axis=0),
        "V": f["h"].T @ d_t,
        "U": f["h"].T @ d_g,
        "a": (f["t"] * f["g"]).T @ d_e,
        "c": f["z"].T @ d_logit,
        "cb": np.array([d_logit.sum()]),
    }


def fit(bags: list[np.ndarray], y: np.ndarray, totals: tuple[int, int], seed: int = 7) -> Weights:
    """Adam on all bags at once; classes weigh alike, then the output is shifted to the share
    of the classes among all labelled rows. Without both classes the score is constant."""
    prior = float(np.log(max(totals[1], 0.5) / max(totals[0], 0.5)))
    rng = np.random.default_rng(seed)
    shapes = {"W": (N_FEATURES, HIDDEN), "wb": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "cb": (1,)}
    p = {k: rng.normal(0, 0.3, s) * (len(s) > 1 or k in "ac") for k, s in shapes.items()}
    if len(bags) == 0 or len(np.unique(y)) < 2:
        p["c"] = p["c"] * 0
        return Weights(np.zeros(N_FEATURES), np.ones(N_FEATURES), p, prior)
    rows = np.concatenate(bags).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1]))
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = (rows - mean) / scale
    importance = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        for k, d in _gradients(p, x, starts, y, importance).items():
            d = d + DECAY * p[k]
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Weights(mean, scale, p, prior)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    per_class: int = PER_CLASS,
) -> Weights:
    """Weights from at most ``per_class`` labelled documents of each class outside the
    held-out quarter, long ones included; of several rows of an id one counts. Only the features of those documents reach the driver, so their
    size is bounded."""
    sample = labelled_sample(labels, label, per_class)
    text = with_labels(docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")), sample, "doc")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [passages(v.as_py()) for v in batch.column(4)]
            blobs = [_condensed(r).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(blobs, pa.binary())], names=["place", "content", "label", "total", "rows"])

    encoded = text.select(F.md5(F.col("doc").cast("string")).alias("place"), F.xxhash64("text").alias("content"), "label", "total", "text").mapInArrow(
        encode, "place string, content bigint, label int, total bigint, rows binary"
    )
    found = sorted(one_each(encoded).collect(), key=lambda r: (r.place, r.label, r["rows"]))
    bags = [np.frombuffer(r["rows"], np.float32).reshape(-1, N_FEATURES) for r in found]
    totals = {r.label: r.total for r in found}
    return fit(bags, np.array([r.label for r in found], np.float64), (totals.get(0, 0), totals.get(1, 0)))


def _condensed(rows: np.ndarray, most: int = LEARN_PASSAGES) -> np.ndarray:
    """At most so many rows: the means of neighbouring ones, of numbers as equal as can be."""
    if len(rows) <= most:
        return rows
    starts = np.arange(most) * len(rows) // most
    sizes = np.diff(np.append(starts, len(rows)))
    return (np.add.reduceat(rows.astype(np.float64), starts, axis=0) / sizes[:, None]).astype(rows.dtype)


def scorer(weights: Weights) -> Callable[[Column], Column]:
    """A column function that scores whole texts, from 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        # Passages of a few documents at a time, so that long texts don't pile up.
        bags, at, held = [], 0, 0
        for i, text in enumerate(texts):
            bags.append(passages(text))
            held += len(bags[-1])
            if held >= 8192 or i + 1 == len(texts):
                starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1])).astype(np.int64)
                out[at : i + 1] = _sigmoid(weights.logits(np.concatenate(bags), starts))
                bags, at, held = [], i + 1, 0
        return pd.Series(out)

    return score


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    **options: object,
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1), ``predicted``.

    Every passage of a text is encoded, a gated attention weighs them, and the weighted mean
    is scored. Only the text enters a score; rows equal in text have equal scores. Null and
    blank texts have one passage without words and a score like any other. A null id is not
    held out. Labels without documents are passed over, with none at all the score is 0.5.
    """
    score = scorer(train(docs, labels, id_col=id_col, text_col=text_col, **options))
    return docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        held_out(F.col(f"`{id_col}`")).alias("held_out"),
        score(F.col(f"`{text_col}`")).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    **options: object,
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns."""
    score = scorer(train(docs, labels, id_col=id_col, text_col=text_col, **options))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row"),
        score(F.col(f"`{text_col}`")).alias("score"),
    ).where(F.col("score") >= threshold)
    return rows.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
