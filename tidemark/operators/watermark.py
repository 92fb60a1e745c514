"""Keep only observations later than what has been published."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce, localtime
from tidemark.schema import SERIES, find_date_column


def latest_time(df: DataFrame, column: str | None = None) -> DataFrame:
    """One row with the latest observation time of ``df``."""
    column = column or find_date_column(df.columns)
    return df.agg(F.max(column).alias("max_obs_time"))


def series_watermarks(events: DataFrame, series: str = SERIES, column: str = "obs_time") -> DataFrame:
    """Latest observation time per series; combined map-side, two columns read."""
    return events.groupBy(series).agg(F.max(column).alias("max_obs_time"))


def filter_newer(
    df: DataFrame,
    cutoff: datetime | str | None,
    column: str = "obs_time",
    zone: str | None = None,
    lag_days: int = 0,
) -> DataFrame:
    """Rows strictly later than ``cutoff``, compared as wall clocks of ``zone``.

    The cutoff is a literal, so the filter reaches the scan. Without a cutoff or
    without the column every row is kept. ``lag_days`` moves the cutoff back.
    """
    if cutoff is None or column not in df.columns:
        return df
    bound = localtime.ntz_literal(effective_cutoff(cutoff, lag_days))
    return df.where(_wall(df, column, zone) > bound)


def narrow_scan(
    df: DataFrame,
    cutoff: datetime | str | None,
    column: str = "obs_time",
    zone: str | None = None,
    lag_days: int = 0,
) -> DataFrame:
    """Leaves out rows that ``filter_newer`` is sure to drop, by a comparison of the stored
    column with a literal, which reaches the scan. For rows not normalised yet: null times
    stay, instants get a day to spare for their zone, and text is left to the filter."""
    if cutoff is None or column not in df.columns:
        return df
    bound, time = effective_cutoff(cutoff, lag_days), F.col(column)
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.TimestampNTZType):
        later = time > localtime.ntz_literal(bound)
    elif isinstance(data_type, T.DateType):
        later = time >= F.lit(bound.date())
    elif isinstance(data_type, T.TimestampType):
        later = time > F.lit((bound - timedelta(days=1)).replace(tzinfo=timezone.utc))
    else:
        return df
    return df.where(time.isNull() | later)


def effective_cutoff(cutoff: datetime | str, lag_days: int = 0) -> datetime:
    moment = datetime.fromisoformat(cutoff) if isinstance(cutoff, str) else cutoff
    return moment.replace(tzinfo=None) - timedelta(days=lag_days)


def filter_newer_than(
    df: DataFrame,
    latest: DataFrame,
    column: str = "obs_time",
    zone: str | None = None,
    lag_days: int = 0,
) -> DataFrame:
    """The same against the one-row result of ``latest_time``, as a scalar subquery."""
    lag = F.make_interval(days=F.lit(lag_days))
    cutoff = latest.select(F.col("max_obs_time") - lag).scalar()
    return df.where(cutoff.isNull() | (_wall(df, column, zone) > cutoff))


def filter_newer_per_series(
    df: DataFrame,
    watermarks: DataFrame,
    series: str = SERIES,
    column: str = "obs_time",
    zone: str | None = None,
    lag_days: int = 0,
) -> DataFrame:
    """Each series against its own watermark; a series without one is kept whole.

    No broadcast hint: series may number in the millions. When the join shuffles, AQE
    splits a series that holds much of the batch.
    """
    lag = F.make_interval(days=F.lit(lag_days))
    bounds = watermarks.select(F.col(series), (F.col("max_obs_time") - lag).alias("_cutoff"))
    joined = df.join(bounds, series, "left")
    later = F.col("_cutoff").isNull() | (_wall(df, column, zone) > F.col("_cutoff"))
    return joined.where(later).select(*df.columns)


def _wall(df: DataFrame, column: str, zone: str | None):
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.TimestampNTZType):
        return F.col(column)
    return coerce.to_time(F.col(column), data_type, zone=zone)
