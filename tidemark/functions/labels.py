"""Version labels, partition and pointer texts, spreadsheet column letters."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats other readers of the tables rely on.
VERSION_FORMAT = "%Y-%m-%dT%H-%M-%S"
POINTER_SUFFIX = "manifest.json"
MANIFEST_FOLDER = "manifest_files"
NOTICE_TYPE = "DATASET_UPDATED"


def version_label(run_time: datetime) -> str:
    """Version label of a run: its UTC instant to the second, sortable as text."""
    if run_time.tzinfo is not None:
        run_time = run_time.astimezone(timezone.utc)
    return run_time.strftime(VERSION_FORMAT)


def version_label_column(utc_time: Column) -> Column:
    """The same label for a column of UTC wall-clock times (TIMESTAMP_NTZ)."""
    return F.translate(F.substring(utc_time.cast("string"), 1, 19), " :", "T-")


def version_of_path(path: Column) -> Column:
    """Version label inside a foreign event path ``.../events/<version>/...``."""
    return F.nullif(F.regexp_extract(path, "/events/([^/]+)/", 1), F.lit(""))


def manifest_pointer(dataset_id: Column, version: Column) -> Column:
    """Where the JSON manifest of a version lies, under the root of the datasets."""
    return F.concat_ws("/", dataset_id, F.lit(MANIFEST_FOLDER), version, F.lit(POINTER_SUFFIX))


def month_path(year: Column, month: Column) -> Column:
    """Partition path of a month, with a two-digit month number."""
    return F.concat(
        F.lit("year="), year.cast("string"), F.lit("/month="), two_digits(month), F.lit("/")
    )


def two_digits(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")


def text_sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def column_index(letters: str) -> int:
    """Zero-based position of a spreadsheet column: A is 0, Z is 25, AA is 26."""
    if not letters.isalpha() or not letters.isascii():
        raise ValueError(f"not a column letter: {letters!r}")
    return int(sum((ord(c) - 64) * 26**power for power, c in enumerate(reversed(letters.upper())))) - 1


def column_index_column(letters: Column) -> Column:
    """``column_index`` over a column of letters."""
    digits = F.transform(F.split(F.upper(letters), ""), lambda c: F.ascii(c) - 64)
    return (F.aggregate(digits, F.lit(0), lambda total, d: total * 26 + d) - 1).cast("int")
