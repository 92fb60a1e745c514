"""Raw observations to typed ones: times, numbers, dataset zone, required fields."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce, localtime
from tidemark.operators.extract import all_present, drop_missing
from tidemark.schema import find_date_column


def coerce_dates(
    df: DataFrame,
    column: str = "obs_time",
    formats: Sequence[str] = (),
    zone: str | None = None,
) -> DataFrame:
    return df.withColumn(
        column, coerce.to_time(F.col(column), df.schema[column].dataType, formats, zone)
    )


def coerce_numbers(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, coerce.to_number(F.col(column), df.schema[column].dataType))


def localize(
    df: DataFrame,
    zone: str,
    column: str = "obs_time",
    on_bad_local_time: str = "raise",
    utc_column: str | None = None,
) -> DataFrame:
    """Attach ``zone`` to wall-clock times.

    The wall clock stays in ``column``; ``utc_column`` adds the instant. Wall clocks a
    clock change skips or repeats fail the job, become null, or shift, as chosen.
    """
    checked = localtime.checked_wall(F.col(column), zone, on_bad_local_time)
    df = df.withColumn(column, checked)
    if utc_column:
        df = df.withColumn(utc_column, localtime.utc_of(F.col(column), zone))
    return df


def normalize(
    df: DataFrame,
    zone: str | None = None,
    formats: Sequence[str] = (),
    on_bad_local_time: str = "raise",
) -> DataFrame:
    """Coerce times and numbers, check local times, drop rows missing either field."""
    required = [name for name in ("obs_time", "value") if name in df.columns]
    df = coerce_fields(df, zone, formats)
    if zone and "obs_time" in df.columns:
        df = localize(df, zone, "obs_time", on_bad_local_time)
    return drop_missing(_computed_once(df, required), required)


def coerce_fields(df: DataFrame, zone: str | None = None, formats: Sequence[str] = ()) -> DataFrame:
    """Times and numbers of all rows, null where they can't be read."""
    if "obs_time" in df.columns:
        df = coerce_dates(df, "obs_time", formats, zone)
    return coerce_numbers(df, "value") if "value" in df.columns else df


def count_rows(
    df: DataFrame,
    zone: str | None = None,
    formats: Sequence[str] = (),
    cutoff: datetime | None = None,
) -> DataFrame:
    """What normalisation and a dataset-wide watermark make of the rows, as one row:
    ``rows_read``, ``rejected_time``, ``rejected_value`` (of readable time), ``not_newer``
    (of both readable) and ``usable``, the rest. One pass over two columns."""
    df = _computed_once(coerce_fields(df, zone, formats), [c for c in ("obs_time", "value") if c in df.columns])
    time = F.col("obs_time").isNotNull() if "obs_time" in df.columns else F.lit(True)
    value = all_present([(F.col("value"), df.schema["value"].dataType)]) if "value" in df.columns else F.lit(True)
    old = F.lit(False)
    if cutoff is not None and "obs_time" in df.columns:
        old = F.coalesce(F.col("obs_time") <= localtime.ntz_literal(cutoff), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~time).alias("rejected_time"),
        F.count_if(time & ~value).alias("rejected_value"),
        F.count_if(time & value & old).alias("not_newer"),
        F.count_if(time & value & ~old).alias("usable"),
    )


def _computed_once(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pass columns through a generator.

    A filter on a plain projection is pushed below it and repeats its expressions, and
    filters share no common subexpressions: every text would be parsed again for each
    place the parsed value is used. A filter stops at a generator.
    """
    if not names:
        return df
    others = [name for name in df.columns if name not in names]
    once = df.select(*others, F.inline(F.array(F.struct(*names))))
    return once.select(*df.columns)


def add_year_month(
    df: DataFrame, column: str | None = None, drop_invalid: bool = False
) -> DataFrame:
    """Add the wall-clock year and month of the date column; unreadable dates give nulls."""
    column = column or find_date_column(df.columns)
    if column is None:
        raise ValueError("no obs_time or obs_date column")
    time = coerce.to_time(F.col(column), df.schema[column].dataType)
    df = df.withColumns({"year": F.year(time), "month": F.month(time)})
    return df.dropna(subset=["year", "month"]) if drop_invalid else df
