"""Text to time and number, where anything unreadable becomes null."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import localtime

# What counts as a number.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"
# All of a text that is a date, or a date and a time of day without a zone. A year has four
# digits: five or more are a day number of a spreadsheet or a year and month run together.
WALL_PATTERN = r"^[\x00-\x20]*\d{4}(-\d{1,2}(-\d{1,2}([T ]+(\d{1,2}(:\d{1,2}(:\d{1,2}(\.\d*)?)?)?)?)?)?)?[\x00-\x20]*$"
# A date and more: what is no wall clock can be an instant.
DATED_PATTERN = r"^[\x00-\x20]*\d{4}-\d{1,2}-\d{1,2}[T ]"
# Year, month and day run together.
COMPACT_PATTERN = r"^(\d{4})(\d{2})(\d{2})$"
# Pattern letters for a zone or an offset, outside quotes.
ZONE_LETTERS = r"[VzOXxZ]"


def to_number(column: Column, data_type: T.DataType) -> Column:
    """DOUBLE or null. Guards the cast, which alone would accept suffixes such as ``1d``."""
    if not isinstance(data_type, T.StringType):
        return column.try_cast("double")
    number = F.trim(column).try_cast("double")
    finite = number.between(F.lit(-1.7976931348623157e308), F.lit(1.7976931348623157e308))
    return F.when(column.rlike(NUMBER_PATTERN) & finite, number).when(
        column.rlike(INFINITY_PATTERN), number
    )


def to_time(
    column: Column,
    data_type: T.DataType,
    formats: Sequence[str] = (),
    zone: str | None = None,
) -> Column:
    """TIMESTAMP_NTZ wall clock or null.

    Text is read as ISO, years of four digits, with or without dashes, or by the first of ``formats`` that fits. A zoned column, and ISO
    text with a zone or an offset, becomes the wall clock of ``zone`` (UTC if none); text
    without one is a wall clock already; what can be read as neither is null. Formats can
    hold no zone.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return column
    if isinstance(data_type, T.TimestampType):
        return localtime.wall_of_instant(column, zone or "UTC")
    if isinstance(data_type, T.DateType):
        return column.cast("timestamp_ntz")
    if not isinstance(data_type, T.StringType):
        raise ValueError(f"{data_type.simpleString()} is not a time column")
    if formats:
        for fmt in formats:
            if re.search(ZONE_LETTERS, re.sub(r"'[^']*'", "", fmt)):
                raise ValueError(f"a time format without a zone is needed: {fmt!r}")
        return F.coalesce(*[_by_format(column, fmt) for fmt in formats])
    text = F.trim(column)
    instant = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp")
    compact = F.regexp_replace(text, COMPACT_PATTERN, "$1-$2-$3")
    return F.when(F.length(text) == 8, F.when(compact.rlike(WALL_PATTERN), compact.try_cast("timestamp_ntz"))).when(text.rlike(WALL_PATTERN), text.try_cast("timestamp_ntz")).when(
        text.rlike(DATED_PATTERN), localtime.wall_of_instant(instant, zone or "UTC")
    )


def _by_format(column: Column, fmt: str) -> Column:
    # The permissive CSV reader parses zone-less times by pattern and gives null for the
    # rest; try_to_timestamp would go through the session zone. \x01 never splits a cell.
    options = {"timestampNTZFormat": fmt, "sep": "\x01", "quote": "", "mode": "PERMISSIVE"}
    return F.from_csv(F.trim(column), "t timestamp_ntz", options)["t"]
