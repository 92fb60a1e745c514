"""Wall-clock arithmetic on TIMESTAMP_NTZ that never consults the session zone."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_TRANSITIONS = re.compile(r"^(UTC|GMT|Z|Etc/\S+|[+-]\d{2}:\d{2})$")
DAY_SECONDS = 86_400
BAD_LOCAL_TIME_MODES = ("raise", "null", "shift")


def ntz_literal(value: object) -> Column:
    """A datetime (or its text) as a constant TIMESTAMP_NTZ, whatever the session zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def has_transitions(zone: str) -> bool:
    return _NO_TRANSITIONS.match(zone) is None


def utc_of(wall: Column, zone: str) -> Column:
    """UTC wall clock of a local one; gaps and overlaps follow Spark's own choice."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def wall_of(utc: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def wall_of_instant(instant: Column, zone: str) -> Column:
    """Wall clock of a TIMESTAMP in ``zone``, through its epoch microseconds."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return wall_of(ntz_literal("1970-01-01 00:00:00") + since_epoch, zone)


def localize(wall: Column, zone: str, on_bad_local_time: str = "raise") -> Column:
    """UTC wall clock of ``wall``, with a choice for times a clock change skips or repeats."""
    return utc_of(checked_wall(wall, zone, on_bad_local_time), zone)


def checked_wall(wall: Column, zone: str, on_bad_local_time: str = "raise") -> Column:
    """``wall`` where it names one instant; otherwise an error, null, or ``wall`` (shift)."""
    if on_bad_local_time not in BAD_LOCAL_TIME_MODES:
        raise ValueError(f"on_bad_local_time must be one of {BAD_LOCAL_TIME_MODES}")
    if on_bad_local_time == "shift" or not has_transitions(zone):
        return wall
    bad = is_bad_local_time(wall, zone)
    if on_bad_local_time == "null":
        return F.when(~bad, wall)
    message = F.concat(F.lit(f"no unique {zone} time for "), wall.cast("string"))
    return F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(wall)


def is_bad_local_time(wall: Column, zone: str) -> Column:
    """Whether a clock change skips or repeats a wall clock, for a change of any size.

    The offsets a day to either side give two candidate instants. A wall clock is skipped
    when neither candidate shows it again, and repeated when two different ones do. Where
    both offsets agree, nearly everywhere, the rest is not evaluated.
    """
    seconds = _seconds(wall)
    before = _offset_at(seconds - DAY_SECONDS, zone)
    after = _offset_at(seconds + DAY_SECONDS, zone)
    shown_by_before = _offset_at(seconds - before, zone) == before
    shown_by_after = _offset_at(seconds - after, zone) == after
    return (before != after) & (shown_by_before == shown_by_after)


def offset_text(wall: Column, zone: str) -> Column:
    """UTC offset of a wall clock, as ``-03:00``."""
    seconds = _seconds(wall)
    utc = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(seconds), zone))
    minutes = F.floor((seconds - utc) / 60).cast("int")
    size = F.abs(minutes)
    return F.concat(
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def _seconds(wall: Column) -> Column:
    """Whole seconds from 1970-01-01 00:00 to a wall clock, both without a zone."""
    time_of_day = F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)
    return F.unix_date(F.to_date(wall)).cast("bigint") * DAY_SECONDS + time_of_day


def _offset_at(utc_seconds: Column, zone: str) -> Column:
    """Seconds ``zone`` is ahead of UTC at an instant.

    In whole epoch seconds, where ``from_utc_timestamp`` with a constant zone looks the
    zone up once per task; ``convert_timezone`` looks it up for every row.
    """
    shown = F.from_utc_timestamp(F.timestamp_seconds(utc_seconds), zone)
    return F.unix_seconds(shown) - utc_seconds
