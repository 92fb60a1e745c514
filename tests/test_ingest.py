"""Whole runs: the golden sequence, months, versions, source check, watermark scopes."""

from datetime import datetime, timedelta

import pytest
from frames import at, daily, observations, sorted_rows
from pyspark.sql import functions as F

from tidemark import DatasetSpec, SeriesStore, run_ingest
from tidemark.plans import reads
from tidemark.plans.repair import check_consistency
from tidemark.schema import ENRICHED_EVENT

KEYS = ("obs_time", "internal_series_code")
SPEC = DatasetSpec("d1", KEYS, frequency="D", timezone="America/Argentina/Buenos_Aires", provider="P")
SAFE = DatasetSpec("d1", KEYS, frequency="D", timezone="UTC", provider="P")


def run(spark, root, raw, when, spec=SAFE, **options):
    return run_ingest(spark, spec, raw, root, run_time=at(when), **options)


def test_golden_sequence(spark, root):
    """Source rows 1000, 1002, 1005, 1005 add 1000, 2, 3 and nothing."""
    added = []
    for day, rows in enumerate((1000, 1002, 1005, 1005), 1):
        result = run(spark, root, daily(spark, rows), f"2024-01-0{day}T10:00:00+00:00")
        added.append((result.rows_added, result.rows_total, result.published))
    assert added == [(1000, 1000, True), (2, 1002, True), (3, 1005, True), (0, 0, False)]
    store = SeriesStore(spark, root, "d1")
    assert [r.version for r in reads.version_history(store).collect()] == [
        "2024-01-01T10-00-00",
        "2024-01-02T10-00-00",
        "2024-01-03T10-00-00",
    ]
    assert store.events().count() == store.projections().count() == store.index().count() == 1005
    assert check_consistency(store).first().consistent


def hourly(spark, stations, hours, start=0):
    """Readings of a few stations: the value tells station and hour."""
    rows = [
        (str(datetime(2021, 8, 20) + timedelta(hours=h)), name, 100.0 * n + h)
        for n, name in enumerate(stations)
        for h in range(start, hours)
    ]
    return observations(spark, rows)


def test_first_run_then_more_hours(spark, root):
    one = run(spark, root, hourly(spark, ("ridge", "valley"), 10), "2021-09-01T00:00:00+00:00")
    assert (one.rows_added, one.rows_total, one.months) == (20, 20, ((2021, 8),))
    store = SeriesStore(spark, root, "d1")
    two = run(spark, root, hourly(spark, ("ridge", "valley"), 13), "2021-09-02T00:00:00+00:00")
    assert (two.rows_added, two.rows_total) == (6, 26)
    added = sorted_rows(reads.version_delta(store, two.version).select("value"))
    assert added == [(10.0,), (11.0,), (12.0,), (110.0,), (111.0,), (112.0,)]
    for name in ("ridge", "valley"):
        assert reads.read_series_month(store, name, 2021, 8).count() == 13
    assert reads.read_series_month(store, "ridge", 2021, 9).count() == 0


def test_several_series_and_months(spark, root):
    """From 20 August to 3 September: every series has its rows in both months."""
    run(spark, root, hourly(spark, ("ridge", "valley", "coast"), 15 * 24), "2021-10-01T00:00:00+00:00")
    store = SeriesStore(spark, root, "d1")
    for n, name in enumerate(("ridge", "valley", "coast")):
        for month, hours in ((8, range(12 * 24)), (9, range(12 * 24, 15 * 24))):
            rows = reads.read_series_month(store, name, 2021, month).collect()
            assert sorted(r.value for r in rows) == [100.0 * n + h for h in hours]
    assert [f.name for f in ENRICHED_EVENT] + ["year", "month"] == store.projections().columns


def test_changed_value_of_a_known_key_is_ignored(spark, root):
    run(spark, root, observations(spark, [("2024-01-01", "S", 1.0)]), "2024-03-01T00:00:00+00:00")
    again = run(
        spark, root, observations(spark, [("2024-01-01", "S", 9.0)]), "2024-03-02T00:00:00+00:00", watermark="off"
    )
    assert not again.published and again.reason == "no new rows"


def test_watermark_scopes(spark, root):
    run(spark, root, observations(spark, [("2024-01-01", "A", 1.0), ("2024-03-01", "B", 2.0)]), "2024-04-01T00:00:00+00:00")
    lagging = observations(spark, [("2024-02-01", "A", 3.0), ("2024-02-02", "B", 4.0), ("2023-01-01", "C", 5.0)])
    dropped = run(spark, root, lagging, "2024-04-02T00:00:00+00:00")
    assert not dropped.published
    per_series = run(spark, root, lagging, "2024-04-03T00:00:00+00:00", watermark="series")
    assert per_series.rows_added == 2
    everything = run(spark, root, lagging, "2024-04-04T00:00:00+00:00", watermark="off")
    assert everything.rows_added == 1


def test_series_marks_read_new_versions_only(spark, root):
    store = SeriesStore(spark, root, "d1")
    assert store.series_marks().count() == 0
    marks = lambda: {r.internal_series_code: r.max_obs_time.hour for r in store.series_marks().collect()}
    run(spark, root, hourly(spark, ("ridge", "valley"), 6), "2021-09-01T00:00:00+00:00")
    assert marks() == {"ridge": 5, "valley": 5}
    second = run(spark, root, hourly(spark, ("ridge", "coast"), 9), "2021-09-02T00:00:00+00:00", watermark="series")
    assert second.rows_added == 3 + 9
    files = store.events_since("2021-09-01T00-00-00").inputFiles()
    assert files and all(f"version={second.version}" in f for f in files)
    assert marks() == {"ridge": 8, "valley": 5, "coast": 8}


def test_lag_days_lets_late_rows_in_once(spark, root):
    run(spark, root, observations(spark, [("2024-01-10", "A", 1.0)]), "2024-04-01T00:00:00+00:00")
    late = observations(spark, [("2024-01-05", "A", 2.0), ("2024-01-10", "A", 1.0), ("2024-01-01", "A", 3.0)])
    assert run(spark, root, late, "2024-04-02T00:00:00+00:00", lag_days=7).rows_added == 1


def test_full_reload_skips_the_source_check_only(spark, root):
    files = spark.createDataFrame([("f.xlsx", "h1", 10)], "path string, sha256 string, size bigint")
    rows = observations(spark, [("2024-01-01", "A", 1.0)])
    assert run(spark, root, rows, "2024-04-01T00:00:00+00:00", sources=files).published
    same = run(spark, root, rows, "2024-04-02T00:00:00+00:00", sources=files)
    assert same.reason == "source unchanged"
    forced = run(spark, root, rows, "2024-04-03T00:00:00+00:00", sources=files, full_reload=True)
    assert forced.reason == "no new rows"
    other = spark.createDataFrame([("f.xlsx", "h2", 11)], "path string, sha256 string, size bigint")
    more = observations(spark, [("2024-01-01", "A", 1.0), ("2024-01-02", "A", 2.0)])
    assert run(spark, root, more, "2024-04-04T00:00:00+00:00", sources=other).rows_added == 1
    manifest = SeriesStore(spark, root, "d1").current_manifest()
    assert (manifest.source.sha256, manifest.source.file_count, manifest.source.size) == ("h2", 1, 11)


def test_an_earlier_or_equal_version_is_refused(spark, root):
    run(spark, root, observations(spark, [("2024-01-01", "A", 1.0)]), "2024-04-02T00:00:00+00:00")
    with pytest.raises(ValueError, match="not later"):
        run(spark, root, observations(spark, [("2024-01-02", "A", 1.0)]), "2024-04-02T00:00:00+00:00")


def test_duplicates_in_one_batch_all_pass_and_one_is_projected(spark, root):
    rows = observations(spark, [("2024-01-01", "A", 1.0), ("2024-01-01", "A", 2.0)])
    result = run(spark, root, rows, "2024-04-02T00:00:00+00:00")
    assert (result.rows_added, result.rows_total) == (2, 1)
    store = SeriesStore(spark, root, "d1")
    assert store.events().count() == 2
    assert [r.value for r in store.projections().collect()] == [2.0]


def test_zoned_dataset_fails_on_a_skipped_local_time(spark, root):
    rows = observations(spark, [("2007-12-30 00:10:00", "A", 1.0)])
    with pytest.raises(Exception, match="no unique"):
        run(spark, root, rows, "2024-04-02T00:00:00+00:00", spec=SPEC)
    store = SeriesStore(spark, root, "d1")
    assert store.current_version() is None and store.events().count() == 0


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo", "America/Argentina/Buenos_Aires"], indirect=True)
def test_the_session_zone_changes_nothing(spark, root, session_zone):
    rows = observations(spark, [("2007-12-29 23:30:00", "A", 1.0), ("2024-01-01", "A", 2.0), ("2024-01-31 23:59:59.5", "A", 3.0)])
    result = run(spark, root, rows, "2024-04-02T00:00:00+00:00", spec=SPEC)
    assert result.months == ((2007, 12), (2024, 1))
    store = SeriesStore(spark, root, "d1")
    hashes = {r[0] for r in store.index().select("key_hash").collect()}
    import hashlib

    expected = ("2007-12-29 23:30:00-03:00|A", "2024-01-01 00:00:00-03:00|A", "2024-01-31 23:59:59.500000-03:00|A")
    assert hashes == {hashlib.sha1(k.encode()).hexdigest() for k in expected}
    stamped = store.events().select(F.unix_micros("vintage_date")).distinct().collect()
    assert [r[0] for r in stamped] == [1712016000000000]
    again = run(spark, root, rows, "2024-04-03T00:00:00+00:00", spec=SPEC, watermark="off")
    assert not again.published
