"""The merged read model: only new versions are read, and it equals a rebuild from all events."""

import glob
import os
import random

import pytest
from frames import at, observations, sorted_rows
from pyspark.sql import functions as F

from tidemark import DatasetSpec, SeriesStore, consolidate_months, publish, repair, run_ingest
from tidemark.store import latest_month_status

KEYS = ("obs_time", "internal_series_code")
SPEC = DatasetSpec("d", KEYS, frequency="D")


def label(n):
    return f"2024-01-{n:02d}T00-00-00"


def put(store, rows, n):
    return publish(store, observations(store.spark, rows), label(n), KEYS, label(n - 1) if n > 1 else None)


def shown(store):
    return sorted_rows(store.projections().select("obs_time", "internal_series_code", "value", "version"))


def test_equals_a_rebuild_on_repeated_keys_and_ties(spark, root):
    rng = random.Random(7)
    store = SeriesStore(spark, root, "d")
    for n in range(1, 6):
        rows = [
            (f"2023-{rng.randint(1, 4):02d}-0{rng.randint(1, 4)}", rng.choice(["A", "B", None]), float(rng.randint(0, 9)))
            for _ in range(60)
        ]
        put(store, rows + rows[:5], n)
        consolidate_months(store, KEYS, only_incomplete=True)
        merged = shown(store)
        consolidate_months(store, KEYS, full=True)
        assert merged == shown(store) and len(merged) == len({r[:2] for r in merged})


def test_seen_versions_are_not_read_again(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, [("2023-01-01", "A", 1.0), ("2023-02-01", "A", 1.0)], 1)
    put(store, [("2023-01-01", "A", 2.0), ("2023-01-02", "A", 2.0)], 2)
    consolidate_months(store, KEYS)
    built = store.built_versions([(2023, 1), (2023, 2)])
    assert built == {(2023, 1): label(2), (2023, 2): label(2)}
    put(store, [("2023-01-02", "A", 3.0)], 3)
    read = store.events_in([(2023, 1), (2023, 2)], after=built).inputFiles()
    assert read and all(f"version={label(3)}/" in f for f in read)
    february = store.path("projections", "year=2023", "month=02")
    before = sorted(os.listdir(february))
    # Without their events the months can only be merged.
    for path in glob.glob(store.path("events", f"version={label(1)}", "*", "*", "*.parquet")):
        os.rename(path, f"{path}.away")
    assert consolidate_months(store, KEYS) == [(2023, 1), (2023, 2)]
    assert [r[2:] for r in shown(store)] == [(2.0, label(2)), (3.0, label(3)), (1.0, label(1))]
    assert sorted(os.listdir(february)) == before


def test_a_missing_projection_is_built_from_all_events(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, [("2023-01-01", "A", 1.0)], 1)
    consolidate_months(store, KEYS)
    os.rename(store.path("projections", "year=2023"), store.path("gone"))
    put(store, [("2023-01-02", "A", 2.0)], 2)
    consolidate_months(store, KEYS)
    assert [r[2] for r in shown(store)] == [1.0, 2.0]


def test_months_without_a_named_series_are_empty_not_due(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, [("2023-01-01", None, 1.0), ("2023-02-01", "A", 1.0)], 1)
    assert consolidate_months(store, KEYS) == [(2023, 2)]
    status = latest_month_status(store.month_status_log()).select("month", "status")
    assert sorted_rows(status) == [(1, "empty"), (2, "completed")]
    assert store.due_months() == [] and not repair(store)
    put(store, [("2023-01-05", "A", 2.0)], 2)
    assert store.due_months() == [(2023, 1)] and repair(store)
    assert [r[2] for r in shown(store)] == [2.0, 1.0] and not repair(store)


def test_a_bad_month_fails_alone(spark, root):
    store = SeriesStore(spark, root, "d")
    months = [(2022 + m // 12, m % 12 + 1) for m in range(24)]
    put(store, [(f"{y}-{m:02d}-03", "A", float(m)) for y, m in months], 1)
    (bad,) = glob.glob(store.path("events", f"version={label(1)}", "year=2022", "month=07", "*.parquet"))
    sound = open(bad, "rb").read()
    open(bad, "wb").write(b"not a table")
    crc = os.path.join(os.path.dirname(bad), f".{os.path.basename(bad)}.crc")
    if os.path.exists(crc):
        os.rename(crc, f"{crc}.away")
    done = consolidate_months(store, KEYS)
    assert done == [m for m in months if m != (2022, 7)] and store.projections().count() == 23
    assert store.due_months() == [(2022, 7)]
    (failed,) = store.month_status_log().where("status = 'failed'").collect()
    assert (failed.year, failed.month) == (2022, 7) and failed.reason
    with pytest.raises(Exception, match="(?i)parquet|table"):
        consolidate_months(store, KEYS, only_incomplete=True)
    open(bad, "wb").write(sound)
    assert consolidate_months(store, KEYS, only_incomplete=True) == [(2022, 7)]
    assert store.projections().count() == 24 and not store.due_months()


TEXTS = {"45292": 0, "202401": 0, "20240103": 1, "2024-01-04": 1, "2024": 1, "20241399": 0, "+12024-01-01": 0}


def test_day_numbers_and_run_together_months_are_no_times(spark, root):
    rows = spark.createDataFrame([(t, 1.0, "A") for t in TEXTS], "obs_time string, value double, internal_series_code string")
    result = run_ingest(spark, SPEC, rows, root, run_time=at("2024-06-01T00:00:00+00:00"), count_rows=True)
    assert result.published and result.rows_added == sum(TEXTS.values())
    assert result.counts.rejected_time == len(TEXTS) - result.rows_added
    times = sorted(str(r.obs_time) for r in SeriesStore(spark, root, "d").events().collect())
    assert times == ["2024-01-01 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


@pytest.mark.parametrize("far", ["9999-12-31", "2060-01-01"])
def test_a_row_far_in_the_future_fails_the_run(spark, root, far):
    run = lambda rows, day: run_ingest(
        spark, SPEC, observations(spark, rows), root, run_time=at(f"2024-06-{day:02d}T00:00:00+00:00")
    )
    with pytest.raises(ValueError, match="1 rows lie after 2034"):
        run([("2024-01-01", "A", 1.0), (far, "A", 2.0)], 1)
    store = SeriesStore(spark, root, "d")
    assert store.current_version() is None and not os.path.exists(store.path("events", "version=2024-06-01T00-00-00"))
    assert run([("2024-01-01", "A", 1.0)], 2).published
    assert run([("2024-01-02", "A", 1.0)], 3).published


def test_times_beyond_python_are_counted_not_fetched(spark, root):
    rows = spark.sql("SELECT timestamp_ntz'+45292-01-01 00:00:00' AS obs_time, 1.0D AS value, 'A' AS internal_series_code")
    with pytest.raises(ValueError, match="1 rows lie after"):
        run_ingest(spark, SPEC, rows, root, run_time=at("2024-06-01T00:00:00+00:00"))
    assert SeriesStore(spark, root, "d").current_version() is None
