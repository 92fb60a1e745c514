"""Bounded samples of labelled documents for the models that are trained on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows of each class a model is fitted on, at most. Everything else, the scoring
# included, covers all rows.
PER_CLASS = 1500


def held_out(id_col: Column) -> Column:
    """Rows that no model learns from: the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, per_class: int = PER_CLASS, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_class`` ids of each class 0 and 1, the first by MD5, as rows ``sample_id``,
    ``label``, ``total`` (rows of the class that could be learned from). Held-out rows, null
    ids and null labels are left out; of several labels of an id the smallest counts."""
    rows = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("sample_id"))
        .agg(F.min(label).alias("label"))
    )
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("total"))
    picked = None
    for value in (0, 1):
        first = rows.where(F.col("label") == value).orderBy(F.md5(F.col("sample_id").cast("string")), "sample_id")
        first = first.limit(per_class)
        picked = first if picked is None else picked.union(first)
    return picked.join(F.broadcast(sizes), "label")


def one_each(rows: DataFrame) -> DataFrame:
    """One row per ``place`` (what stands for an id), the one of the smallest ``content``
    (hash of the text), so that an id which many rows share weighs and costs as one."""
    least = F.min(F.struct("content", *(c for c in rows.columns if c not in ("place", "content")))).alias("row")
    return rows.groupBy("place").agg(least).select("place", "row.*").drop("content")


def with_labels(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of a sample. It is broadcast: its size is bounded by its parameter."""
    return docs.join(F.broadcast(sample), F.col(f"`{id_col}`") == F.col("sample_id"))
