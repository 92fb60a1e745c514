"""Make a delta a published version: events, index, source files, then the manifest row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import with_key_hash
from tidemark.operators.delta import without_known
from tidemark.operators.fingerprint import combined_fingerprint
from tidemark.store import Month, SeriesStore, check_label


NO_ROWS = "no new rows"


@dataclass(frozen=True)
class PublishResult:
    published: bool
    version: str
    rows_added: int = 0
    rows_total: int = 0
    months: tuple[Month, ...] = ()
    reason: str = ""


def publish(
    store: SeriesStore,
    delta: DataFrame,
    version: str,
    keys: Sequence[str],
    expected_current: str | None,
    zone: str | None = None,
    escape_separator: bool = False,
    sources: DataFrame | None = None,
    sources_stored: bool = False,
    created_at: datetime | None = None,
    known_new: bool = False,
    batch: tuple[str, int] | None = None,
    latest: datetime | None = None,
    attempts: int = 10,
) -> PublishResult:
    """Publish ``delta`` as ``version`` if the current version is still ``expected_current``.

    The delta is evaluated once, by the write of its events; counts, months and key
    hashes come from reading those files back, narrow columns only. That is a durable
    table, so a lost executor costs a task and never the delta. ``known_new`` says the
    delta has already been anti-joined with the index, ``sources_stored`` that the source
    files of this version are already in their table. ``batch`` is the stream and number of
    the micro-batch behind the delta, for the manifest.

    A delta with a time after ``latest`` is refused: such a time, most likely a misread one,
    would be the watermark of all later runs.

    Nothing is visible until the manifest row is written, as the last step. A failure
    before that removes what this call wrote and is raised again.

    Several writers may publish at once, under different labels: one of them follows each
    version. One that loses this race leaves out the keys that the winners added and
    tries again from the stored rows, ``attempts`` times in all. It
    gives up if its label is not later than the winner's.
    """
    check_label(version)
    current = store.current_manifest()
    current_version = current.version if current else None
    if current_version != expected_current:
        return PublishResult(False, version, reason=f"current version is {current_version}")
    if current_version is not None and version <= current_version:
        raise ValueError(f"version {version} is not later than {current_version}")

    try:
        for _ in range(attempts):
            result, delta = _attempt(
                store, delta, version, keys, expected_current, zone, escape_separator, sources,
                sources_stored, created_at, known_new, batch, latest,
            )
            if result is not None:
                store.unstage(version)
                return result
            winner = store.current_version()
            if version <= winner:
                break
            # What the winners added is left out; the rest is new to them too.
            added = store.index().where(F.col("version") > (expected_current or ""))
            delta = without_known(with_key_hash(delta, keys, zone, escape_separator), added).select(*delta.columns)
            expected_current, known_new = winner, True
        store.discard(version)
        return PublishResult(False, version, reason=f"version {winner} was published meanwhile")
    except Exception:
        if store.current_version() != version:
            store.discard(version)
        raise


def _attempt(
    store: SeriesStore,
    delta: DataFrame,
    version: str,
    keys: Sequence[str],
    after: str | None,
    zone: str | None,
    escape_separator: bool,
    sources: DataFrame | None,
    sources_stored: bool,
    created_at: datetime | None,
    known_new: bool,
    batch: tuple[str, int] | None,
    latest: datetime | None,
) -> tuple[PublishResult | None, DataFrame]:
    """The outcome, or none if another version follows ``after`` by now, and the stored delta."""
    store.write_events(version, delta)
    stats = store.stats_of(version, delta.schema, latest)
    if stats.late_rows:
        raise ValueError(f"{stats.late_rows} rows lie after {latest}, the latest time allowed")
    if stats.rows == 0:
        store.discard(version)
        return PublishResult(False, version, reason=NO_ROWS), delta

    by_time = "obs_time" in keys
    known = None if known_new else store.index(stats.min_obs_time if by_time else None)
    events = store.read_written(version, delta.schema)
    new_keys = store.write_index(version, events, keys, zone, escape_separator, known)
    rows_total = store.rows_total() + new_keys

    source = None
    if sources is not None:
        store.write_source_files(version, sources)
    if sources is not None or sources_stored:
        source = combined_fingerprint(store.source_files(version)).first()

    if store.current_version() == after and store.append_manifest(
        version,
        stats,
        rows_total,
        delta.schema,
        keys,
        source,
        _aware(created_at or datetime.now(timezone.utc)),
        batch,
        after,
        zone,
        escape_separator,
    ):
        return PublishResult(True, version, stats.rows, rows_total, tuple(stats.month_list)), delta
    return None, store.stage(version, events.select(*delta.columns))


def _aware(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
