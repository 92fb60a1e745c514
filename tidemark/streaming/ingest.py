"""Landed snapshots as a stream: every micro-batch is one ingest run."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.labels import VERSION_FORMAT, version_label
from tidemark.plans.ingest import run_ingest
from tidemark.plans.repair import repair_months
from tidemark.spec import DatasetSpec
from tidemark.store import SeriesStore


def stream_ingest(
    stream: DataFrame,
    spec: DatasetSpec,
    root: str,
    checkpoint: str,
    origin: datetime,
    watermark: str = "off",
) -> DataStreamWriter:
    """A writer that publishes each micro-batch; the caller sets the trigger and starts it.

    A version remembers the stream (the id Spark gives a checkpoint) and the batch it was
    made from, and only a batch of which there is a version already is skipped: Spark
    replays it after a failure. Then the months that a failure left behind are rebuilt. The
    version label is ``origin`` plus one second per batch, or one second after the newest
    version if that is later. Rows that come again are in the key index and add nothing.
    """

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = SeriesStore(spark, root, spec.dataset_id)
        made_from = (_stream_id(spark, checkpoint), batch_id)
        if store.batch_versions(*made_from):
            repair_months(store)
            return
        version = _next_label(origin + timedelta(seconds=batch_id), store.current_version())
        run_ingest(
            spark,
            spec,
            # A landed file is often one row group, which one task reads: what is done to its
            # rows is spread over all.
            batch.hint("rebalance"),
            root,
            run_time=origin + timedelta(seconds=batch_id),
            version=version,
            watermark=watermark,
            batch=made_from,
        )

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish_batch)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the checkpoint, which Spark writes before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def _next_label(moment: datetime, current: str | None) -> str:
    label = version_label(moment)
    if current is None or label > current:
        return label
    return version_label(datetime.strptime(current, VERSION_FORMAT) + timedelta(seconds=1))
