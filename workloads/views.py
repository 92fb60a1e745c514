"""The given tables seen as series data, and a store built from them by Spark."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import DatasetSpec, SeriesStore, run_ingest

ZONE = "America/Argentina/Buenos_Aires"
ORDER_KEYS = ("obs_time", "order_key")
ORDERS = DatasetSpec(
    "orders",
    ORDER_KEYS,
    frequency="D",
    timezone=ZONE,
    provider="tpch",
    unit="usd",
)

# Three source snapshots, each holding the one before it; the last is the whole table.
VERSIONS = ("2024-01-01T06-00-00", "2024-01-02T06-00-00", "2024-01-03T06-00-00")
SNAPSHOT_ENDS = ("1998-01-01", "2000-01-01", None)

_stores: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint location of the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("obs_time"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderpriority").alias("internal_series_code"),
        F.col("o_orderkey").alias("order_key"),
    )


def order_snapshot(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """The orders a source had when version ``number`` was made."""
    rows, end = order_observations(spark, sf_dir), SNAPSHOT_ENDS[number]
    return rows if end is None else rows.where(F.col("obs_time") < F.lit(end).cast("timestamp_ntz"))


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event values; each hour of the day stands for a version."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("timestamp_ntz").alias("obs_time"),
        "value",
        F.col("event_type").alias("internal_series_code"),
        F.concat(F.lit("v"), F.lpad(F.hour("ts").cast("string"), 2, "0")).alias("version"),
        "event_id",
    )


def line_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices by flag, status and ship date; the line number stands for a version."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("obs_time"),
        F.col("l_extendedprice").alias("value"),
        F.concat_ws("_", "l_returnflag", "l_linestatus").alias("internal_series_code"),
        F.concat(F.lit("v"), F.col("l_linenumber").cast("string")).alias("version"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )


def dirty_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text, with unreadable numbers early in an hour and times late in one."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("internal_series_code"),
        F.when(F.minute("ts") >= 52, "n/a").otherwise(F.col("ts").cast("string")).alias("obs_time"),
        F.when(F.minute("ts") < 6, "s/d").otherwise(F.col("value").cast("string")).alias("value"),
    )


def run_time(number: int) -> datetime:
    return datetime.strptime(VERSIONS[number], "%Y-%m-%dT%H-%M-%S").replace(tzinfo=timezone.utc)


def build_order_store(spark: SparkSession, sf_dir: str, root: str, versions: int = 3) -> SeriesStore:
    """Ingest the snapshots one after the other."""
    for number in range(versions):
        run_ingest(
            spark, ORDERS, order_snapshot(spark, sf_dir, number), root, run_time=run_time(number)
        )
    return SeriesStore(spark, root, ORDERS.dataset_id)


def order_store(spark: SparkSession, sf_dir: str) -> SeriesStore:
    """One such store per session and data folder, for the queries that only read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        root = scratch(spark)
        build_order_store(spark, sf_dir, root)
        _stores[key] = root
    return SeriesStore(spark, _stores[key], ORDERS.dataset_id)


def time_text(name: str):
    return F.col(name).cast("string")


def micros_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def cents(name: str):
    """Sum of a two-decimal amount in whole cents, so the order of addition is no matter."""
    return F.sum(F.round(F.col(name) * 100).cast("bigint"))
