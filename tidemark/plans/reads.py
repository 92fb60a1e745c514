"""Reads over the stored tables. All are lazy; month and version filters prune partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_wins
from tidemark.schema import SERIES
from tidemark.store import SeriesStore


def read_series_month(store: SeriesStore, series: str, year: int, month: int) -> DataFrame:
    """Projection of one series and month. Rows are sorted by series inside each file,
    so the series filter skips row groups."""
    return read_month(store, year, month).where(F.col(SERIES) == series)


def read_month(store: SeriesStore, year: int | None, month: int | None) -> DataFrame:
    if year is None or month is None:
        raise ValueError("both year and month are required")
    return store.projections().where((F.col("year") == year) & (F.col("month") == month))


def export(rows: DataFrame, target: str) -> str:
    """Write rows as Parquet if ``target`` says so, else as CSV; returns where they went."""
    if target.endswith(".parquet"):
        rows.write.mode("overwrite").parquet(target)
        return target
    target = target if target.endswith(".csv") else f"{target}.csv"
    rows.write.mode("overwrite").option("header", True).csv(target)
    return target


def preview(rows: DataFrame, order: list[str], size: int = 10) -> DataFrame:
    """First rows by an explicit order; Spark keeps the top rows per task."""
    return rows.orderBy(*order).limit(size)


def read_year(store: SeriesStore, year: int) -> DataFrame:
    return store.projections().where(F.col("year") == year)


def read_last_n_months(store: SeriesStore, n: int, today: date) -> DataFrame:
    """The calendar month of ``today`` and the ``n - 1`` before it."""
    last = today.year * 12 + today.month - 1
    number = F.col("year") * 12 + F.col("month") - 1
    return store.projections().where(number.between(last - n + 1, last))


def events_for_month(store: SeriesStore, year: int, month: int) -> DataFrame:
    """All published rows of a month, every version of them. Only the directories of that
    month are listed and read."""
    return store.events_in([(year, month)])


def audit_month(store: SeriesStore, year: int, month: int) -> DataFrame:
    """The same, oldest version first; by series and time within one, so that a version
    with most of the month's rows is sorted by many tasks."""
    rows = events_for_month(store, year, month)
    order = ["version", *[c for c in (SERIES, "obs_time", "value") if c in rows.columns]]
    return rows.orderBy(*order)


def full_history(store: SeriesStore) -> DataFrame:
    return store.events()


def last_n_versions(store: SeriesStore, n: int) -> DataFrame:
    oldest = store.versions()[-n:][:1] if n > 0 else []
    return store.events().where(F.col("version") >= oldest[0] if oldest else F.lit(False))


def version_delta(store: SeriesStore, version: str) -> DataFrame:
    return store.events_of(version)


def as_of_version(store: SeriesStore, version: str, keys: list[str] | None = None) -> DataFrame:
    """Rows published up to ``version``; with ``keys`` reduced to the table as it stood."""
    rows = store.events().where(F.col("version") <= version)
    return latest_wins(rows, keys) if keys else rows


def version_history(store: SeriesStore) -> DataFrame:
    return store.manifests().select("version").orderBy("version")


def month_version_index(store: SeriesStore) -> DataFrame:
    """Versions with rows in each month, from the manifests alone."""
    return (
        store.months_of()
        .where("year IS NOT NULL")
        .groupBy("year", "month")
        .agg(
            F.sort_array(F.collect_set("version")).alias("versions"),
            F.countDistinct("version").alias("event_count"),
        )
    )


def manifest_summary(store: SeriesStore) -> DataFrame:
    """Per version, rows added and rows in total."""
    return store.manifests().select(
        "version",
        F.col("outputs.rows_added_this_version").alias("rows_added"),
        F.col("outputs.rows_total").alias("rows_total"),
    )


def manifest_lookup(store: SeriesStore, version: str) -> DataFrame:
    """Manifest row of a version; no row if there is none."""
    return store.manifests().where(F.col("version") == version)


def latest_watermark(store: SeriesStore) -> DataFrame:
    """Latest observation time of the current version, from its manifest."""
    return store.manifests().agg(
        F.max_by("outputs.max_obs_time", "version").alias("max_obs_time")
    )
