"""Merge what was published since into the read model of the months it touches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import consolidate, with_series
from tidemark.store import COMPLETED, EMPTY, FAILED, IN_PROGRESS, Month, SeriesStore, in_months


def affected_months(rows: DataFrame) -> DataFrame:
    """Distinct ``(year, month)`` of dated rows, in order."""
    return rows.select("year", "month").dropna().distinct().orderBy("year", "month")


def consolidate_months(
    store: SeriesStore,
    keys: Sequence[str],
    months: Iterable[Month] | None = None,
    only_incomplete: bool = False,
    tie_breakers: Sequence[str | Column] | None = None,
    skip_unreadable: bool = False,
    full: bool = False,
) -> list[Month]:
    """Bring the projections of ``months`` (default: all published ones) up to date.

    The latest row of a key among all versions is the latest among the stored one and the
    rows of later versions. So a month that was built to some version is merged with what
    was published since, and no event it has seen is read again; one without later versions
    is left as it is. Where later versions brought only keys that no row had before, as the
    index tells, their rows are appended and no stored row is read. ``full`` builds the months from all their events, as is needed after a
    change of ``keys`` or ``tie_breakers``.

    ``only_incomplete`` leaves out months whose last completed rebuild has seen all their
    versions. Every status names the newest version committed when the rebuild began.
    Returns the months that are up to date and have something to show. A month of which no
    row names its series is ``empty``, one without any row stays ``in_progress``.

    The months are one job. If it fails, they are halved until the bad ones stand alone: the
    others are built, and those are ``failed``, with the reason, and due in the next run. Only
    if no month can be built the error is raised.
    """
    wanted = sorted(set(months)) if months is not None else published_months(store)
    if only_incomplete:
        due = set(store.due_months())
        wanted = [m for m in wanted if m in due]
    if not wanted:
        return []

    version = store.current_version()
    interrupted = store.interrupted_months(wanted)
    store.append_month_status(wanted, IN_PROGRESS, version)
    built = {} if full else store.built_versions(wanted)
    published = store.versions_in(wanted)
    stale = {m for v, m in published if v > built.get(m, "")}
    pending = [(v, m) for v, m in published if v > built.get(m, "")]
    appendable = set() if full else _with_new_keys_only(store, keys, pending, built, interrupted)

    def build(part: list[Month]) -> None:
        grown = [m for m in part if m in appendable]
        # Whatever fails from here on is merged, which leaves out rows that are there already.
        appendable.difference_update(part)
        merged = sorted(set(part).difference(grown))
        if merged:
            before = {m: built[m] for m in merged if m in built}
            rows = store.events_in(merged, skip_unreadable, before)
            if before:
                kept = store.projections().where(in_months(list(before)))
                rows = kept.unionByName(rows.select(*kept.columns))
            store.write_projections(consolidate(rows, keys, tie_breakers))
        if grown:
            rows = with_series(store.events_in(grown, skip_unreadable, built))
            one_version_each = len(grown) == sum(m in set(grown) for _, m in pending)
            store.write_projections(rows, append=True, in_place=one_version_each)

    failures = _isolated(build, [m for m in wanted if m in stale])
    if failures and len(failures) == len(wanted):
        raise next(iter(failures.values()))
    # A month is a directory; the listing says which ones exist.
    sound = [m for m in wanted if m not in failures]
    completed = [m for m in sound if store.has_projection(m)]
    shown = set(completed)
    had_rows = {m for _, m in published}
    store.append_month_status(completed, COMPLETED, version)
    store.append_month_status([m for m in sound if m not in shown and m in had_rows], EMPTY, version)
    for month, error in failures.items():
        store.append_month_status([month], FAILED, version, reason=f"{type(error).__name__}: {error}"[:1000])
    return completed


def _with_new_keys_only(
    store: SeriesStore,
    keys: Sequence[str],
    pending: Sequence[tuple[str, Month]],
    built: dict[Month, str],
    interrupted: set[Month],
) -> set[Month]:
    """Months whose pending rows each have a key of their own, in no row of the read model.

    A version adds to the index the keys that it was the first to bring. Where these are as many
    as its rows in a month, all its rows there have new keys. That needs the time in the key, one
    spelling of keys in all versions, and a whole index. What an interrupted rebuild may have
    written in part is left to the merge, and so is a month with many small files.
    """
    if not pending or "obs_time" not in keys or not store.hashed_alike(keys):
        return set()
    versions = sorted({v for v, _ in pending})
    brought = store.index_rows(versions)
    rows = store.months_of().where(F.col("version").isin(versions)).select("version", "year", "month", "rows")
    counts = {(r.version, (r.year, r.month)): r["rows"] for r in rows.collect()}
    months = {m for _, m in pending}
    months -= {m for v, m in pending if brought.get((v, m)) != counts[v, m]}
    # Not built, yet with files: nobody says which rows these hold.
    months -= {m for m in months if m in interrupted or (m not in built and store.has_projection(m))}
    return {m for m in months if not store.is_crowded(m)}


def _isolated(build: Callable[[list[Month]], None], months: list[Month]) -> dict[Month, Exception]:
    """Runs ``build`` for all months, in as few calls as those that fail allow; returns these."""
    if not months:
        return {}
    try:
        build(months)
    except Exception as error:  # noqa: BLE001  whatever it is, it stops its own month only
        if len(months) == 1:
            return {months[0]: error}
        half = len(months) // 2
        return {**_isolated(build, months[:half]), **_isolated(build, months[half:])}
    return {}


def published_months(store: SeriesStore) -> list[Month]:
    rows = affected_months(store.months_of()).collect()
    return [(r.year, r.month) for r in rows]
