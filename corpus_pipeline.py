"""Training corpus from ``documents``: quality, exact and near copies, mixing, packing.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``documents``; ``run`` writes what a stage returns as Parquet and gives it to the next. The
stages are the operators with their production parameters:

1. quality   documents whose score is under 0.7 go,
2. exact     of texts equal but for white space the longest stays,
3. near      of documents linked by SimHash, as op1 links them, or by a Jaccard similarity of
             at least 0.8 of their five-word shingles the one with the smallest id stays,
4. mixing    each document appears as often as its source's target takes it, perhaps never,
5. packing   one row per document, or piece of a long one, with its bin and offset.

The classifier is trained, so no SQL gives the rows; tests compare each stage with a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, jaccard, mixing, packing, quality_model, simhash
from tidemark.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs, prints=simhash.fingerprints(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixing", mixed), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
