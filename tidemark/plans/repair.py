"""Check the key index against the manifests and rebuild it from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks import ROW_TOLERANCE, consistency_report
from tidemark.plans.consolidation import consolidate_months
from tidemark.store import Month, SeriesStore


def check_consistency(store: SeriesStore, tolerance: int = ROW_TOLERANCE) -> DataFrame:
    expected = store.rows_total() if store.current_version() else None
    return consistency_report(store.pointer(), store.manifests(), store.index(), tolerance, expected)


def rebuild(
    store: SeriesStore, zone: str | None = None, escape_separator: bool = False
) -> bool:
    """Write the index anew from all committed events, as a new generation.

    The old generation stays in use until the new one is complete, so a failed rebuild
    changes nothing. It also compacts: one directory in place of one per version. The
    number of keys it finds is the table's total from then on.
    Returns False if nothing is published.
    """
    manifest = store.current_manifest()
    if manifest is None or not manifest["index"] or not manifest["index"].key_columns:
        return False
    generation = store.index_generation() + 1
    events = store.events().where(F.col("version") <= manifest.version)
    keys = store.write_index(
        manifest.version,
        events,
        manifest["index"].key_columns,
        zone,
        escape_separator,
        known=None,
        generation=generation,
    )
    store.append_generation(generation, manifest.version, keys, zone, escape_separator)
    return True


def repair(
    store: SeriesStore,
    zone: str | None = None,
    escape_separator: bool = False,
    tolerance: int = ROW_TOLERANCE,
) -> bool:
    """Mend what an interrupted run or a lost index left; returns whether there was anything.

    The index is rebuilt if the check fails, by the same rule as ``check_consistency``: one
    count of the index, answered by its footers. Then the read model of every month that
    has a committed version it was not built from is rebuilt.
    """
    mended = repair_index(store, zone, escape_separator, tolerance)
    return bool(repair_months(store)) or mended


def repair_index(
    store: SeriesStore,
    zone: str | None = None,
    escape_separator: bool = False,
    tolerance: int = ROW_TOLERANCE,
) -> bool:
    """Rebuild the index if something is published and the counts differ."""
    if store.current_version() is None:
        return False
    keys = store.index().count()
    if keys and abs(keys - store.rows_total()) <= tolerance:
        return False
    return rebuild(store, zone, escape_separator)


def repair_months(store: SeriesStore) -> list[Month]:
    """Rebuild the read model of the months that are due; returns those written."""
    manifest = store.current_manifest()
    due = store.due_months() if manifest is not None and manifest["index"] else []
    return consolidate_months(store, manifest["index"].key_columns, due) if due else []
