"""One run: a source snapshot in, at most one new published version out."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import with_key_hash
from tidemark.functions.labels import version_label
from tidemark.operators import normalize
from tidemark.operators.delta import relevant_index, without_known
from tidemark.operators.enrich import enrich
from tidemark.operators.fingerprint import file_reads, source_changes
from tidemark.operators.watermark import (
    effective_cutoff,
    filter_newer,
    filter_newer_per_series,
    narrow_scan,
)
from tidemark.plans.consolidation import consolidate_months
from tidemark.plans.publish import NO_ROWS, publish
from tidemark.plans.registry import extractor_of, is_generic, normalizer_of
from tidemark.plans.repair import repair_index, repair_months
from tidemark.sources.paths import literal_path
from tidemark.spec import DatasetSpec
from tidemark.store import Month, SeriesStore, check_label

WATERMARK_SCOPES = ("dataset", "series", "off")

# Paths given to a reader; with more files to read it reads the whole source, for the same rows.
MAX_PATHS = 100_000

# Reads the given files, or the whole source.
Reader = Callable[[list[str] | None], DataFrame]


@dataclass(frozen=True)
class RunResult:
    dataset_id: str
    run_id: str
    version: str
    published: bool
    rows_added: int = 0
    rows_total: int = 0
    months: tuple[Month, ...] = ()
    reason: str = ""
    mended_months: tuple[Month, ...] = ()
    counts: RowCounts | None = None
    # How many source files a reader was asked for.
    files_read: int | None = None


@dataclass(frozen=True)
class RowCounts:
    """What became of the rows of one source, as far as the run read them."""

    rows_read: int
    rejected_time: int
    rejected_value: int
    not_newer: int
    known: int
    added: int


def run_ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    raw: DataFrame | Reader,
    root: str,
    run_time: datetime | None = None,
    version: str | None = None,
    run_id: str | None = None,
    sources: DataFrame | None = None,
    full_reload: bool = False,
    watermark: str = "dataset",
    lag_days: int = 0,
    consolidate: bool = True,
    verify_index: bool = True,
    batch: tuple[str, int] | None = None,
    count_rows: bool = False,
) -> RunResult:
    """Extract, normalise, keep what is new, stamp, publish, rebuild touched months.

    ``sources`` are the fingerprints of the files behind ``raw``; if none changed since
    the current version nothing runs, unless ``full_reload``. If ``raw`` is a function from paths
    to a DataFrame, it is asked only for the files that can bring anything: new and changed ones,
    and those last read in another way (another spec or scope) or for later rows alone. The
    result is that of reading all, for extractors that look at one file at a time; after a change
    inside a plugin ``full_reload`` is needed. ``watermark`` keeps rows
    later than the last version's latest time (``dataset``), than each series' own
    (``series``), or all rows (``off``), leaving the choice to the key index alone.
    ``verify_index`` counts the index against the manifest first, and rebuilds it if they
    disagree. Months whose read model an interrupted run left behind are rebuilt first,
    whatever the source brings, if ``consolidate``. ``batch`` names the micro-batch behind
    ``raw``, for the manifest.

    A row later than ``spec.horizon_days`` after the run time fails the run, with nothing
    published: as the watermark it would silently stop all later rows. A source, or the files
    read of it, of which every row was rejected for its time or value fails the run. With
    ``count_rows`` the result tells what became of the rows, at the price of one more pass
    over their times and values; rows that the scan already left out as too old are not
    among them. Both need the library's own normaliser.
    """
    if watermark not in WATERMARK_SCOPES:
        raise ValueError(f"watermark must be one of {WATERMARK_SCOPES}")
    if callable(raw) and sources is None:
        raise ValueError("a reader of files needs their fingerprints as sources")
    run_time = run_time or datetime.now(timezone.utc)
    version = version or version_label(run_time)
    run_id = run_id or str(uuid.uuid4())
    store = SeriesStore(spark, root, spec.dataset_id)

    mended: list[Month] = []
    files_read: int | None = None

    def finished(reason: str) -> RunResult:
        return RunResult(
            spec.dataset_id, run_id, version, False, reason=reason, mended_months=tuple(mended),
            files_read=files_read,
        )

    if verify_index:
        repair_index(store, spec.timezone, spec.escape_separator)
    if consolidate:
        mended = repair_months(store)
    current = store.current_manifest()
    current_version = current.version if current else None
    check_label(version)
    if current_version is not None and version <= current_version:
        raise ValueError(f"version {version} is not later than {current_version}")

    since = None
    if current is not None and watermark == "dataset" and current.outputs.max_obs_time:
        since = effective_cutoff(current.outputs.max_obs_time, lag_days)
    if sources is not None:
        # Written first and read back, so that no file is hashed twice.
        store.write_source_files(version, sources)
        changes = source_changes(
            store.source_files(version), store.source_files(current_version), full_reload
        )
        if callable(raw):
            how = _way_of_reading(spec, watermark, lag_days)
            before = store.file_reads(current_version)
            store.write_file_reads(version, file_reads(changes, before, how, since, version))
            changed = store.file_reads(version).where(F.col("read_version") == version)
        else:
            changed = changes.where("changed")
        files_read = changed.count() if callable(raw) else None
        if files_read == 0 or (files_read is None and not changed.limit(1).count()):
            store.discard(version)
            return finished("source unchanged")
        if callable(raw):
            raw = raw(_paths(changed) if files_read <= MAX_PATHS else None)

    extracted = extractor_of(spec)(spec, raw)
    if is_generic(spec):
        # Before anything is parsed or checked, so that the scan leaves old rows out.
        extracted = narrow_scan(extracted, since, zone=spec.timezone)
    rows = normalizer_of(spec)(spec, extracted)
    if since is not None:
        rows = filter_newer(rows, since)
    elif current is not None and watermark == "series":
        rows = filter_newer_per_series(rows, store.series_marks(), lag_days=lag_days)

    hashed = with_key_hash(rows, spec.primary_keys, spec.timezone, spec.escape_separator)
    index = None
    if current is not None and since is not None:
        # A hash can match nothing outside its own month: rows past the cutoff need its month
        # and later ones.
        index = store.index(since if "obs_time" in spec.primary_keys else None)
    elif current is not None:
        # Other rows can be of any month. They are stored first, so that no source is read
        # twice; then their months and a bitmap of their hashes say which keys matter.
        hashed = store.stage(version, hashed)
        months = _months_of(hashed) if "obs_time" in spec.primary_keys else None
        index = relevant_index(store.index(None, months), hashed)
    added = without_known(hashed, index)
    result = publish(
        store,
        enrich(added, spec, version, run_time),
        version,
        spec.primary_keys,
        expected_current=current_version,
        zone=spec.timezone,
        escape_separator=spec.escape_separator,
        sources_stored=sources is not None,
        created_at=run_time,
        known_new=True,
        batch=batch,
        latest=_horizon(spec, run_time),
    )
    store.unstage(version)
    counts = None
    if is_generic(spec) and (count_rows or result.reason == NO_ROWS):
        counts = _count(spec, extracted, since, result.rows_added)
        rejected = counts.rejected_time + counts.rejected_value
        if counts.rows_read and rejected == counts.rows_read:
            raise ValueError(
                f"no row of {rejected} is usable: {counts.rejected_time} without a readable time, "
                f"{counts.rejected_value} without a readable value"
            )
    if not result.published:
        return replace(finished(result.reason), counts=counts if count_rows else None)
    if consolidate:
        consolidate_months(store, spec.primary_keys, _dated(result.months))
    return RunResult(
        spec.dataset_id,
        run_id,
        version,
        True,
        result.rows_added,
        result.rows_total,
        result.months,
        mended_months=tuple(mended),
        counts=counts,
        files_read=files_read,
    )


def _count(spec: DatasetSpec, rows: DataFrame, since: datetime | None, added: int) -> RowCounts:
    found = normalize.count_rows(rows, spec.timezone, spec.time_formats, since).first()
    return RowCounts(
        found.rows_read,
        found.rejected_time,
        found.rejected_value,
        found.not_newer,
        found.usable - added,
        added,
    )


def _way_of_reading(spec: DatasetSpec, watermark: str, lag_days: int) -> str:
    """What, beside its content and the cutoff of the dataset, decides what a file gives. Marks
    of series only move on, so there the lag alone counts."""
    lag = lag_days if watermark == "series" else None
    return hashlib.sha256(repr((spec, watermark, lag)).encode()).hexdigest()


def _paths(files: DataFrame) -> list[str]:
    return sorted(literal_path(r.path) for r in files.select("path").collect())


def _horizon(spec: DatasetSpec, run_time: datetime) -> datetime | None:
    if spec.horizon_days is None:
        return None
    return run_time.replace(tzinfo=None) + timedelta(days=spec.horizon_days)


def _months_of(rows: DataFrame) -> list[Month]:
    """Calendar months of the rows; one column is read, one row a month comes back."""
    time = F.col("obs_time")
    months = rows.select(F.year(time).alias("year"), F.month(time).alias("month")).dropna().distinct()
    return sorted((r.year, r.month) for r in months.collect())


def _dated(months: Sequence[Month]) -> list[Month]:
    return [m for m in months if m[0] is not None]
