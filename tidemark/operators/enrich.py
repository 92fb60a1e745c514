"""Stamp a delta with dataset, unit, version and vintage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce
from tidemark.schema import ENRICHED_EVENT, KEY_HASH, SERIES
from tidemark.spec import DatasetSpec

# Fixed value: the only quality mark an ingest gives.
QUALITY_OK = "OK"


def default_series_code(df: DataFrame, dataset_id: str) -> DataFrame:
    """Use the dataset id as series code if the column is absent; nulls are left alone."""
    return df if SERIES in df.columns else df.withColumn(SERIES, F.lit(dataset_id))


def derive_obs_date(df: DataFrame) -> DataFrame:
    """Calendar day of ``obs_time``; an ``obs_date`` without ``obs_time`` stays as it is."""
    if "obs_time" in df.columns:
        time = coerce.to_time(F.col("obs_time"), df.schema["obs_time"].dataType)
        return df.withColumn("obs_date", F.to_date(time))
    if "obs_date" in df.columns:
        return df
    return df.withColumn("obs_date", F.lit(None).cast("date"))


def order_columns(df: DataFrame) -> DataFrame:
    """The fixed columns first, in their order, then all others."""
    fixed = [name for name in ENRICHED_EVENT.names if name in df.columns]
    return df.select(*fixed, *[name for name in df.columns if name not in fixed])


def enrich(df: DataFrame, spec: DatasetSpec, version: str, vintage: datetime) -> DataFrame:
    """All metadata columns of one run.

    ``frequency`` and ``unit`` come from the data if the column exists, nulls included,
    and from the spec otherwise. ``vintage`` is a constant of the run, so a recomputed
    task writes the same value.
    """
    if vintage.tzinfo is None:
        vintage = vintage.replace(tzinfo=timezone.utc)
    micros = int(vintage.timestamp()) * 1_000_000 + vintage.microsecond
    df = default_series_code(df.drop(KEY_HASH), spec.dataset_id)
    stamps = {
        "dataset_id": F.lit(spec.dataset_id),
        "provider": F.lit(spec.provider or ""),
        "source_kind": F.lit(spec.stamped_source_kind),
        "version": F.lit(version),
        "vintage_date": F.timestamp_micros(F.lit(micros)),
        "quality_flag": F.lit(QUALITY_OK),
    }
    if "frequency" not in df.columns:
        stamps["frequency"] = F.lit(spec.frequency)
    if "unit" not in df.columns:
        stamps["unit"] = F.lit(spec.unit or "")
    return order_columns(derive_obs_date(df.withColumns(stamps)))
