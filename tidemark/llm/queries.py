"""The numbered operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.alignment import align
from tidemark.llm.chat import TURN_SCHEMAS, format_chats, in_order, turns_as_calls
from tidemark.llm.common import shared_folder, table
from tidemark.llm.exact_dedup import duplicate_classes
from tidemark.llm.manifest import FIELDS, dataset_proofs, fold, leaf, siblings
from tidemark.llm.mixing import mix
from tidemark.llm.neighbours import nearest
from tidemark.llm.packing import pack
from tidemark.llm.quality_model import quality_scores
from tidemark.llm.quality_rules import judged
from tidemark.llm.registry import ORACLES, QUERIES, query
from tidemark.llm.simhash import near_classes
from tidemark.llm.sql import CHAT_SQL, EXACT_DEDUP_SQL, MIXING_SQL, SUBSTRING_SQL, WARC_SQL, manifest_sql
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.toxicity import severities
from tidemark.llm.warc import page_records, read_archives, resolve_revisits, write_archives

__all__ = ["ORACLES", "QUERIES"]


@query()
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).drop("content")


@query()
def op2_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query(EXACT_DEDUP_SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(table(spark, sf_dir, "documents"))


@query(MIXING_SQL)
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        "copies",
        F.get("positions", 0).alias("first_position"),
    )
    return mixed.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


@query()
def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(SUBSTRING_SQL)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query(WARC_SQL)
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = shared_folder(spark)
    write_archives(page_records(pages), folder)
    return resolve_revisits(read_archives(spark, folder), dict(pages.dtypes)["page_id"])


@query(CHAT_SQL)
def op6_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_order(format_chats(turns_as_calls(table(spark, sf_dir, "conversations")), TURN_SCHEMAS))


@query()
def op10_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(manifest_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claimed = F.when(tampered, leaf([lower if c == "text" else F.col(c) for c in FIELDS]))
    proofs = dataset_proofs(table(spark, sf_dir, "documents"), claimed=claimed)
    folded = fold(F.coalesce("claimed", "leaf"), F.col("steps"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query()
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
