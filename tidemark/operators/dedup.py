"""One row per key: the latest version, or the first in a given order.

Both are ``row_number() = 1`` over a window on the full key. Spark plans that as a
limit of one row per key inside each map task, the shuffle, then the final limit, so a
key that holds much of the data is down to one row per task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import SERIES


def latest_wins(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "version",
    series: str | None = SERIES,
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Per series and key, the row with the greatest version; a missing version loses.

    Rows equal in key and version are ordered by ``tie_breakers``, by default all other
    columns descending, so the result does not depend on file or task order.
    """
    by = _partition(df, keys, series)
    if tie_breakers is None:
        others = [name for name in df.columns if name not in by and name != version]
        tie_breakers = [F.col(name).desc_nulls_last() for name in others]
    order = [F.col(version).desc_nulls_last(), *tie_breakers]
    return _first_row(df, by, order)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], series: str | None = SERIES
) -> DataFrame:
    """Per series and key, the first row by an explicit order."""
    return _first_row(df, _partition(df, keys, series), list(order))


def with_series(df: DataFrame, series: str = SERIES) -> DataFrame:
    """Rows that name their series; a frame without the column has none."""
    return df.where(F.col(series).isNotNull()) if series in df.columns else df.where(F.lit(False))


def union_versions(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def consolidate(
    events: DataFrame, keys: Sequence[str], tie_breakers: Sequence[str | Column] | None = None
) -> DataFrame:
    """Read model of any number of months at once: named series only, latest version wins."""
    named = with_series(events)
    if "version" not in named.columns:
        raise ValueError("events without a version need keep_first and an order")
    return latest_wins(named, keys, tie_breakers=tie_breakers)


def _partition(df: DataFrame, keys: Sequence[str], series: str | None) -> list[str]:
    names = [series] if series and series in df.columns else []
    return list(dict.fromkeys([*names, *keys]))


def _first_row(df: DataFrame, by: list[str], order: list[str | Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
