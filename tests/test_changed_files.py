"""Runs that read only the files that can bring anything, against runs that read all."""

import random
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path
from urllib.parse import unquote

import pytest
from frames import OBSERVATION, at, sorted_rows

from tidemark import DatasetSpec, SeriesStore, run_ingest
from tidemark.plans import ingest
from tidemark.sources.snapshots import fingerprint_files
from tidemark.sources.tabular import read_csv

SPEC = DatasetSpec("d1", ("obs_time", "internal_series_code"), frequency="D", timezone="UTC")


class Landing:
    """A folder of CSV files, and a reader that notes which of them it opened."""

    def __init__(self, spark, root):
        self.spark, self.folder, self.opened = spark, Path(root) / "landing", []
        self.folder.mkdir()

    def put(self, name, rows):
        body = "".join(f"{t},{v},{s}\n" for t, v, s in rows)
        (self.folder / name).write_text("obs_time,value,internal_series_code\n" + body)

    def __call__(self, paths):
        frame = read_csv(self.spark, str(self.folder) if paths is None else paths, OBSERVATION)
        self.opened = sorted(Path(unquote(p)).name for p in frame.inputFiles())
        return frame

    def run(self, root, day, spec=SPEC, raw=None, **options):
        self.opened = []
        return run_ingest(
            self.spark, spec, raw or self, f"{root}/files", run_time=at(f"2024-01-{day:02d}T00:00:00+00:00"),
            sources=fingerprint_files(self.spark, str(self.folder), "*.csv"), **options,
        )

    def run_all(self, root, day, **options):
        return run_ingest(
            self.spark, SPEC, self(None), f"{root}/all", run_time=at(f"2024-01-{day:02d}T00:00:00+00:00"), **options
        )


@pytest.fixture
def landing(spark, root):
    return Landing(spark, root)


def days(first, last, series, value=1.0):
    return [(datetime(2023, 1, 1) + timedelta(days=d), value, series) for d in range(first, last)]


def events(spark, root):
    rows = SeriesStore(spark, root, "d1").events()
    return sorted_rows(rows.select("version", "internal_series_code", "obs_time", "value"))


def test_one_changed_file_of_many_is_the_one_opened(spark, root, landing):
    for n in range(50):
        landing.put(f"f{n}.csv", days(0, 3, f"S{n}"))
    first = landing.run(root, 1, watermark="off")
    assert (first.files_read, first.rows_added, len(landing.opened)) == (50, 150, 50)
    landing.put("f17.csv", days(0, 4, "S17"))
    second = landing.run(root, 2, watermark="off")
    assert (second.files_read, second.rows_added, second.rows_total) == (1, 1, 151)
    assert landing.opened == ["f17.csv"]
    third = landing.run(root, 3, watermark="off")
    assert (third.files_read, third.reason, landing.opened) == (0, "source unchanged", [])


@pytest.mark.parametrize("scope, lag", [("dataset", 20), ("series", 20), ("off", 0)])
def test_same_versions_as_reading_all(spark, root, landing, scope, lag):
    """Files are replaced, added, emptied and removed at random; some only bring late rows, so
    the cutoff goes back. Keys repeat between files."""
    dice = random.Random(f"{scope}{lag}")
    options = {"watermark": scope, "lag_days": lag, "consolidate": False}
    read = 0
    for day in range(1, 6):
        for n in range(5) if day == 1 else dice.sample(range(8), 2):
            start = dice.randrange(60)
            landing.put(f"f{n}.csv", days(start, start + dice.randrange(25), f"S{dice.randrange(6)}", day))
        if day == 4:
            next(landing.folder.glob("*.csv")).unlink()
        mine, other = landing.run(root, day, **options), landing.run_all(root, day, **options)
        read += mine.files_read
        assert (mine.published, mine.rows_added, mine.rows_total) == (other.published, other.rows_added, other.rows_total)
    assert events(spark, f"{root}/files") == events(spark, f"{root}/all") != []
    assert read < 5 * len(list(landing.folder.glob("*.csv")))


def test_cutoff_that_goes_back_has_files_read_again(spark, root, landing):
    """The second file held rows that were too old when it was read; a version of late rows
    alone moves the cutoff before them."""
    options = {"lag_days": 40, "consolidate": False}
    landing.put("a.csv", days(99, 100, "A"))
    landing.run(root, 1, **options)
    landing.put("b.csv", days(50, 51, "B") + days(100, 101, "B"))
    assert landing.run(root, 2, **options).rows_added == 1
    landing.put("c.csv", days(70, 71, "C"))
    assert landing.run(root, 3, **options).rows_added == 1
    landing.put("d.csv", days(71, 72, "D"))
    result = landing.run(root, 4, **options)
    assert "b.csv" in landing.opened and result.rows_added == 2


def test_other_description_or_scope_reads_all(spark, root, landing):
    for n in range(3):
        landing.put(f"f{n}.csv", days(n, n + 2, f"S{n}"))
    assert landing.run(root, 1).rows_added == 6
    assert landing.run(root, 2).reason == "source unchanged"
    assert landing.run(root, 3, spec=replace(SPEC, provider="P")).files_read == 3
    assert landing.run(root, 4, watermark="off").files_read == 3
    assert landing.run(root, 5, full_reload=True).files_read == 3
    landing.put("f3.csv", days(9, 10, "S3"))
    assert landing.run(root, 6).files_read == 1


def test_version_without_reads_has_all_files_read(spark, root, landing):
    landing.put("a.csv", days(0, 2, "A"))
    landing.run(root, 1)
    landing.put("b.csv", days(2, 3, "B"))
    landing.run(root, 2, raw=landing(None))
    landing.put("c.csv", days(3, 4, "C"))
    assert landing.run(root, 3).files_read == 3


def test_failed_run_leaves_its_files_to_be_read(spark, root, landing):
    landing.put("a.csv", days(0, 2, "A"))
    landing.run(root, 1)
    landing.put("b.csv", [("9998-01-01 00:00:00", 1.0, "B")])
    with pytest.raises(ValueError, match="latest time allowed"):
        landing.run(root, 2)
    landing.put("b.csv", days(2, 3, "B"))
    assert (landing.run(root, 3).rows_added, landing.opened) == (1, ["b.csv"])


def test_names_with_marks_of_patterns(spark, root, landing):
    landing.put("a.csv", days(0, 2, "A"))
    landing.run(root, 1)
    for n, name in enumerate(("b[1].csv", "b{x,y}.csv", "b 2?.csv", "b1.csv", "c%20d.csv")):
        landing.put(name, days(2 + n, 3 + n, "B"))
    assert landing.run(root, 2).rows_added == 5
    landing.put("b[1].csv", days(10, 12, "B"))
    assert (landing.run(root, 3).rows_added, landing.opened) == (2, ["b[1].csv"])


def test_more_files_than_paths_reads_the_source(spark, root, landing, monkeypatch):
    monkeypatch.setattr(ingest, "MAX_PATHS", 1)
    asked = []
    for n in range(3):
        landing.put(f"f{n}.csv", days(n, n + 1, f"S{n}"))
    result = landing.run(root, 1, raw=lambda paths: asked.append(paths) or landing(paths))
    assert (asked, result.rows_added, result.files_read) == ([None], 3, 3)


def test_reader_needs_fingerprints(spark, root, landing):
    with pytest.raises(ValueError, match="fingerprints"):
        run_ingest(spark, SPEC, landing, root)
