"""Keys, coercion and labels against plain Python and pandas."""

import hashlib
from datetime import date, datetime, timezone

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce, labels
from tidemark.functions.keys import key_string, with_key_hash
from tidemark.sources.local import local_rows

SCHEMA = T.StructType(
    [
        T.StructField("t", T.TimestampNTZType()),
        T.StructField("s", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("d", T.DateType()),
    ]
)
KEYS = ["t", "s", "n", "b", "d"]


def _python_key(row, zone=None):
    time = pd.NaT if row["t"] is None else pd.Timestamp(row["t"])
    if zone and row["t"] is not None:
        time = time.tz_localize(zone)
    day = pd.NaT if row["d"] is None else row["d"]
    return "|".join(str(v) for v in (time, row["s"], row["n"], row["b"], day))


ROWS = [
    {"t": datetime(2024, 1, 1), "s": "SERIES_1", "n": 7, "b": True, "d": date(2024, 1, 2)},
    {"t": datetime(2024, 1, 1, 10, 0, 0, 500000), "s": "ñandú|x", "n": -3, "b": False, "d": date(1999, 12, 31)},
    {"t": datetime(2008, 1, 5, 10, 0, 0, 1), "s": "", "n": 0, "b": True, "d": date(2024, 2, 29)},
    {"t": None, "s": None, "n": None, "b": None, "d": None},
]


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo", "America/Argentina/Buenos_Aires"], indirect=True)
@pytest.mark.parametrize("zone", [None, "America/Argentina/Buenos_Aires", "Asia/Kolkata", "UTC"])
def test_hash_equals_that_of_python_text(spark, session_zone, zone):
    rows = local_rows(spark, [{"i": i, **r} for i, r in enumerate(ROWS)], T.StructType([T.StructField("i", T.IntegerType()), *SCHEMA]))
    got = with_key_hash(rows, KEYS, zone).select("i", "key_hash").collect()
    for i, key_hash in got:
        assert len(key_hash) == 40
        assert key_hash == hashlib.sha1(_python_key(ROWS[i], zone).encode()).hexdigest()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.datetimes(datetime(1950, 1, 1), datetime(2100, 1, 1)), st.text(max_size=20), st.integers(-(2**63), 2**63 - 1)
        ),
        min_size=1,
        max_size=60,
    )
)
def test_any_key_text(spark, values):
    values = [(t, s.encode("utf-8", "ignore").decode(), n) for t, s, n in values]
    rows = local_rows(
        spark,
        [{"t": t, "s": s, "n": n} for t, s, n in values],
        T.StructType(SCHEMA.fields[:3]),
    )
    got = sorted(r[0] for r in rows.select(key_string(rows, KEYS[:3])).collect())
    assert got == sorted("|".join(map(str, v)) for v in values)


def test_separator_escaping_is_optional(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    assert with_key_hash(rows, ["x", "y"]).select("key_hash").distinct().count() == 1
    assert with_key_hash(rows, ["x", "y"], escape_separator=True).select("key_hash").distinct().count() == 2


def test_float_keys_need_permission(spark):
    rows = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    with pytest.raises(ValueError):
        with_key_hash(rows, ["x"])
    texts = rows.select(key_string(rows, ["x"], allow_float=True)).collect()
    assert [r[0] for r in texts] == ["1.5", "nan", "nan"]


NUMBERS = [
    "1", " 1 ", "1.5", "1e5", "1E-3", "1d", "1.5f", "0x10", "inf", "+inf", "-Infinity", "nan", "NaN", "1_000",
    "1,000", "", ".5", "5.", "True", "1e", "--1", "\t3\n", "1e400", "s/d", "-0.0", None,
]


def test_numbers_as_in_pandas(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(NUMBERS)], "i int, v string")
    got = dict(rows.select("i", coerce.to_number(F.col("v"), T.StringType())).collect())
    for i, text in enumerate(NUMBERS):
        want = pd.to_numeric(pd.Series([text], dtype=object), errors="coerce").iloc[0]
        assert (got[i] is None) if pd.isna(want) else got[i] == want, text


TIMES = ["2024-01-01", "2024", "n/a", "2024-01-01 10:00", " 2024-01-05 ", "2024-13-01", "2024-02-30", "", "1500-01-01", "2300-01-01", "2024-01-01T10:00:00.25"]


def test_times_as_in_pandas(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(TIMES)], "i int, v string")
    got = dict(rows.select("i", coerce.to_time(F.col("v"), T.StringType())).collect())
    for i, text in enumerate(TIMES):
        want = pd.to_datetime(pd.Series([text]), errors="coerce").iloc[0]
        if text[:4] in ("1500", "2300"):
            # Out of reach of the clock of pandas, and nothing special here.
            want = pd.Timestamp(datetime.fromisoformat(text))
        assert (got[i] is None) if pd.isna(want) else got[i] == want.to_pydatetime(), text


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"], indirect=True)
@pytest.mark.parametrize(
    "text, wall",
    [
        ("2024-01-01T00:00:00Z", "2023-12-31 21:00:00"),
        ("2024-01-01 00:00:00+05:00", "2023-12-31 16:00:00"),
        ("2024-01-01 00:00:00.25 -0300", "2024-01-01 00:00:00.25"),
        ("2024-01-01 00:00:00.25-0300", "2024-01-01 00:00:00.25"),
        ("2024-07-01 12:00:00 Europe/Paris", "2024-07-01 07:00:00"),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:00"),
        ("2024-01-01", "2024-01-01 00:00:00"),
        ("2024-01-01 00:00:00+99:00", None),
        ("x+05:00", None),
    ],
)
def test_text_with_a_zone_becomes_the_wall_clock_of_the_dataset(spark, session_zone, text, wall):
    time = coerce.to_time(F.lit(text), T.StringType(), zone="America/Argentina/Buenos_Aires")
    assert spark.range(1).select(time.cast("string")).first()[0] == wall


def test_formats_hold_no_zone():
    with pytest.raises(ValueError, match="without a zone"):
        coerce.to_time(F.lit("x"), T.StringType(), ["yyyy-MM-dd HH:mm XXX"])


@pytest.mark.parametrize("session_zone", ["UTC", "America/Argentina/Buenos_Aires"], indirect=True)
def test_times_by_format_ignore_the_session_zone(spark, session_zone):
    texts = ["30/12/2007 00:10", "2024-05-06", "06.05.24", '"', "x,y"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string")
    time = coerce.to_time(F.col("v"), T.StringType(), ["dd/MM/yyyy HH:mm", "yyyy-MM-dd", "dd.MM.yy"])
    got = [r[1] for r in rows.select("i", time.cast("string")).orderBy("i").collect()]
    assert got == ["2007-12-30 00:10:00", "2024-05-06 00:00:00", "2024-05-06 00:00:00", None, None]


@pytest.mark.parametrize("text, position", [("A", 0), ("b", 1), ("Z", 25), ("AA", 26), ("AZ", 51), ("BA", 52), ("XFD", 16383)])
def test_column_letters(spark, text, position):
    assert labels.column_index(text) == position
    assert spark.range(1).select(labels.column_index_column(F.lit(text))).first()[0] == position


def test_column_letters_reject_other_text():
    for text in ("", "1", "A1", "Ñ"):
        with pytest.raises(ValueError):
            labels.column_index(text)


def test_version_labels(spark):
    moment = datetime(2025, 11, 3, 4, 5, 6, 789, tzinfo=timezone.utc)
    assert labels.version_label(moment) == "2025-11-03T04-05-06"
    assert labels.version_label(datetime(2025, 11, 3)) == "2025-11-03T00-00-00"
    wall = F.lit("2025-11-03 04:05:06.000789").cast("timestamp_ntz")
    assert spark.range(1).select(labels.version_label_column(wall)).first()[0] == "2025-11-03T04-05-06"


def test_paths_and_pointers(spark):
    one = spark.range(1)
    path = F.lit("s3a://bucket/datasets/d/events/2024-01-01T00-00-00/data/year=2024/month=01/part-0.parquet")
    assert one.select(labels.version_of_path(path)).first()[0] == "2024-01-01T00-00-00"
    assert one.select(labels.version_of_path(F.lit("/tmp/x"))).first()[0] is None
    assert one.select(labels.month_path(F.lit(2024), F.lit(3))).first()[0] == "year=2024/month=03/"
    pointer = labels.manifest_pointer(F.lit("d"), F.lit("v1"))
    assert one.select(pointer).first()[0] == "d/manifest_files/v1/manifest.json"
    digest = one.select(labels.text_sha256(F.lit("ñ"))).first()[0]
    assert digest == hashlib.sha256("ñ".encode()).hexdigest()
