"""Zone handling against pandas, in several session zones."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import localtime
from tidemark.operators.normalize import localize

ZONES = [
    "America/Argentina/Buenos_Aires",
    "America/New_York",
    "Europe/Madrid",
    "Australia/Lord_Howe",
    "Asia/Kolkata",
    "UTC",
]
SESSIONS = ["UTC", "Asia/Tokyo", "America/Argentina/Buenos_Aires"]


def _walls():
    around = [
        "2007-12-30", "2008-03-16", "2008-10-19", "2009-03-15", "2024-03-10", "2024-11-03",
        "2024-03-31", "2024-10-27", "2024-04-07", "2024-10-06", "2024-07-01",
    ]
    for day in around:
        yield from pd.date_range(pd.Timestamp(day) - pd.Timedelta(hours=2), periods=18, freq="30min")


def _walls_of(spark):
    rows = [(str(t),) for t in _walls()]
    return spark.createDataFrame(rows, "text string").withColumn("wall", F.col("text").cast("timestamp_ntz"))


def _pandas_utc(text, zone):
    try:
        moment = pd.Timestamp(text).tz_localize(zone, ambiguous="raise", nonexistent="raise")
    except Exception:
        return None
    return str(moment.tz_convert("UTC").tz_localize(None))


@pytest.mark.parametrize("session_zone", SESSIONS, indirect=True)
@pytest.mark.parametrize("zone", ZONES)
def test_utc_times_and_bad_ones_as_in_pandas(spark, session_zone, zone):
    utc = localtime.localize(F.col("wall"), zone, "null").cast("string")
    got = {r[0]: r[1] for r in _walls_of(spark).select("text", utc).collect()}
    assert got == {text: _pandas_utc(text, zone) for text in got}


@pytest.mark.parametrize("zone", ZONES)
def test_offset_text_as_python_prints_it(spark, zone):
    rows = _walls_of(spark)
    rows = rows.where(~localtime.is_bad_local_time(F.col("wall"), zone))
    for text, offset in rows.select("text", localtime.offset_text(F.col("wall"), zone)).collect():
        assert str(pd.Timestamp(text).tz_localize(zone)).endswith(offset)


def test_raise_null_and_shift(spark):
    zone = "America/Argentina/Buenos_Aires"
    rows = spark.createDataFrame([("2007-12-30 00:10:00",), ("2024-01-01 00:00:00",)], "t string")
    rows = rows.select(F.col("t").cast("timestamp_ntz").alias("obs_time"))
    with pytest.raises(Exception, match="no unique"):
        localize(rows, zone).collect()
    kept = localize(rows, zone, on_bad_local_time="null").where("obs_time IS NOT NULL")
    assert kept.count() == 1
    assert localize(rows, zone, on_bad_local_time="shift").where("obs_time IS NOT NULL").count() == 2
    with pytest.raises(ValueError):
        localize(rows, zone, on_bad_local_time="guess")


@pytest.mark.parametrize("session_zone", SESSIONS, indirect=True)
def test_wall_clock_of_an_instant(spark, session_zone):
    instant = spark.range(1).select(F.timestamp_micros(F.lit(1704067200500000)).alias("i"))
    wall = localtime.wall_of_instant(F.col("i"), "America/Argentina/Buenos_Aires")
    assert instant.select(wall.cast("string")).first()[0] == "2023-12-31 21:00:00.5"
