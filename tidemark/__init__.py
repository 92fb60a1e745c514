"""Incremental series tables on Spark.

See README.md for the data model; ``run_ingest`` is the way in.
"""

from tidemark.plans.changes import change_feed
from tidemark.plans.consolidation import consolidate_months
from tidemark.plans.ingest import RunResult, run_ingest
from tidemark.plans.publish import PublishResult, publish
from tidemark.plans.registry import register_extractor, register_normalizer
from tidemark.plans.repair import check_consistency, rebuild, repair
from tidemark.spec import CategorySpec, DatasetSpec, SeriesSpec
from tidemark.store import SeriesStore
from tidemark.streaming.ingest import stream_ingest

__all__ = [
    "CategorySpec",
    "DatasetSpec",
    "PublishResult",
    "RunResult",
    "SeriesSpec",
    "SeriesStore",
    "change_feed",
    "check_consistency",
    "consolidate_months",
    "publish",
    "rebuild",
    "register_extractor",
    "register_normalizer",
    "repair",
    "run_ingest",
    "stream_ingest",
]
