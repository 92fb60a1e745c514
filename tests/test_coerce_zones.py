"""Text times with zones that are not plain offsets."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce

TEXTS = {
    "2024-01-01 00:00:00 EST": datetime(2024, 1, 1, 5),
    "2024-01-01 00:00:00 UTC+03:00": datetime(2023, 12, 31, 21),
    "2024-01-01 00:00:00 GMT+3": datetime(2023, 12, 31, 21),
    "2024-01-01 00:00:00 Etc/GMT+3": datetime(2024, 1, 1, 3),
    "2024-01-01 00:00:00+05:30:00": datetime(2023, 12, 31, 18, 30),
    "2024-01-01 00:00:00 Nowhere/Else": None,
    "T12:30:00": None,
    "2024-01-01": datetime(2024, 1, 1),
    " 2024-01-01T10:20 ": datetime(2024, 1, 1, 10, 20),
    "2024-01-01 10:20:30.5": datetime(2024, 1, 1, 10, 20, 30, 500000),
}


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"], indirect=True)
def test_no_zone_is_dropped(spark, session_zone):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = rows.select("t", coerce.to_time(F.col("t"), T.StringType(), zone="UTC").alias("w")).collect()
    assert {r.t: r.w for r in got} == TEXTS
