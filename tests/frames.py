"""Small frames shared by the tests."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.schema import OBSERVATION


def observations(spark, rows):
    """Rows ``(iso time, series, value)`` as typed observations."""
    text = spark.createDataFrame(rows, "t string, s string, v double")
    return text.select(
        F.col("t").cast("timestamp_ntz").alias("obs_time"),
        F.col("v").alias("value"),
        F.col("s").alias("internal_series_code"),
    )


def daily(spark, days, series="S"):
    """``days`` consecutive daily observations from 2020-01-01 on."""
    return spark.range(days).select(
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias(
            "obs_time"
        ),
        F.col("id").cast("double").alias("value"),
        F.lit(series).alias("internal_series_code"),
    )


def at(text):
    return datetime.fromisoformat(text)


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


__all__ = ["OBSERVATION", "at", "daily", "observations", "sorted_rows"]
