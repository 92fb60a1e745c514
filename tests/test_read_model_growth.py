"""Rows with keys of their own are appended to the read model: no stored row is read or written again."""

import os

import pytest
from frames import at, observations, sorted_rows

from tidemark import DatasetSpec, SeriesStore, consolidate_months, publish, run_ingest

KEYS = ("obs_time", "internal_series_code")
SPEC = DatasetSpec("d", KEYS, frequency="D")
JANUARY = ("year=2023", "month=01")


def ingest(spark, root, rows, day, spec=SPEC, **options):
    return run_ingest(
        spark, spec, observations(spark, rows), root, run_time=at(f"2024-01-{day:02d}T00:00:00+00:00"), watermark="off", **options
    )


def files(store):
    return {f for f in os.listdir(store.path("projections", *JANUARY)) if f.endswith(".parquet")}


def shown(store):
    return sorted_rows(store.projections().select("obs_time", "internal_series_code", "value", "version"))


def rebuilt(store):
    consolidate_months(store, KEYS, full=True)
    return shown(store)


def test_new_keys_are_appended(spark, root):
    store = SeriesStore(spark, root, "d")
    ingest(spark, root, [("2023-01-01", "A", 1.0), ("2023-01-01", "B", 1.0)], 1)
    first = files(store)
    ingest(spark, root, [("2023-01-01", "A", 5.0), ("2023-01-02", "A", 2.0), ("2023-01-02", None, 2.0)], 2)
    assert first < files(store)
    merged = shown(store)
    assert merged == rebuilt(store) and len(merged) == 3


def test_equal_keys_of_a_version_are_merged(spark, root):
    store = SeriesStore(spark, root, "d")
    ingest(spark, root, [("2023-01-01", "A", 1.0)], 1)
    first = files(store)
    ingest(spark, root, [("2023-01-02", "A", 2.0), ("2023-01-02", "A", 3.0)], 2)
    assert not first & files(store)
    merged = shown(store)
    assert [r[2] for r in merged] == [1.0, 3.0] and merged == rebuilt(store)


def test_versions_not_compared_with_the_index_are_merged(spark, root):
    store = SeriesStore(spark, root, "d")
    for n, value in ((1, 1.0), (2, 2.0)):
        label = f"2024-01-{n:02d}T00-00-00"
        publish(store, observations(spark, [("2023-01-01", "A", value)]), label, KEYS, store.current_version())
        consolidate_months(store, KEYS)
    assert [r[2] for r in shown(store)] == [2.0]


def test_another_spelling_of_keys_is_merged(spark, root):
    store = SeriesStore(spark, root, "d")
    zoned = DatasetSpec("d", KEYS, frequency="D", timezone="America/Argentina/Buenos_Aires")
    ingest(spark, root, [("2023-01-01", "A", 1.0)], 1)
    assert ingest(spark, root, [("2023-01-01", "A", 2.0)], 2, zoned).published
    assert [r[2] for r in shown(store)] == [2.0]


@pytest.mark.parametrize("first", [True, False])
def test_an_append_that_did_not_complete_is_merged(spark, root, monkeypatch, first):
    store = SeriesStore(spark, root, "d")
    if not first:
        ingest(spark, root, [("2023-01-01", "A", 1.0)], 1)

    def broken(self, rows, *args, **kwargs):
        written(self, rows, *args, **kwargs)
        raise OSError("lost before the status")

    written = SeriesStore.write_projections
    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "write_projections", broken)
        with pytest.raises(OSError):
            ingest(spark, root, [("2023-01-02", "A", 2.0), ("2023-01-03", "A", 3.0)], 2)
    ingest(spark, root, [("2023-01-04", "A", 4.0)], 3)
    merged = shown(store)
    assert [r[2] for r in merged] == ([] if first else [1.0]) + [2.0, 3.0, 4.0] and merged == rebuilt(store)


def test_many_small_files_are_written_anew(spark, root, monkeypatch):
    monkeypatch.setattr("tidemark.store.MANY_FILES", 3)
    store = SeriesStore(spark, root, "d")
    for day in range(1, 7):
        ingest(spark, root, [(f"2023-01-{day:02d}", "A", float(day))], day)
        assert len(files(store)) <= 3
    assert [r[2] for r in shown(store)] == [float(day) for day in range(1, 7)]
