"""Key strings and their SHA-1, equal to those of Python's ``str`` on the same values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import localtime
from tidemark.schema import KEY_HASH

# How the stored hashes spell separators and missing values.
SEPARATOR = "|"
MISSING_TEXT = "None"
MISSING_TIME = "NaT"
MISSING_FLOAT = "nan"


def key_text(
    column: Column, data_type: T.DataType, zone: str | None = None, allow_float: bool = False
) -> Column:
    """Text of one key value; never null, so that no part of a key can vanish."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(column, F.lit(MISSING_TEXT))
    if isinstance(data_type, T.BooleanType):
        return F.when(column, "True").when(~column, "False").otherwise(MISSING_TEXT)
    if isinstance(data_type, T.TimestampNTZType):
        return F.coalesce(_time_text(column, zone), F.lit(MISSING_TIME))
    if isinstance(data_type, T.TimestampType):
        shown_in = zone or "UTC"
        return F.coalesce(
            _time_text(localtime.wall_of_instant(column, shown_in), shown_in), F.lit(MISSING_TIME)
        )
    if isinstance(data_type, T.DateType):
        return F.coalesce(column.cast("string"), F.lit(MISSING_TIME))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        if not allow_float:
            raise ValueError("a floating-point key has no stable text; cast it or pass allow_float")
        return F.when(F.isnan(column) | column.isNull(), MISSING_FLOAT).otherwise(
            column.cast("string")
        )
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return F.coalesce(column.cast("string"), F.lit(MISSING_TEXT))
    raise ValueError(f"{data_type.simpleString()} cannot be part of a key")


def _time_text(wall: Column, zone: str | None) -> Column:
    text = wall.cast("string")
    text = F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)
    return F.concat(text, localtime.offset_text(wall, zone)) if zone else text


def key_string(
    df: DataFrame,
    keys: Sequence[str],
    zone: str | None = None,
    escape_separator: bool = False,
    allow_float: bool = False,
) -> Column:
    """Key values of a row joined by a vertical bar."""
    parts = []
    for name in keys:
        text = key_text(F.col(name), df.schema[name].dataType, zone, allow_float)
        if escape_separator:
            text = F.replace(
                F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\" + SEPARATOR)
            )
        parts.append(text)
    return F.concat_ws(SEPARATOR, *parts)


def with_key_hash(
    df: DataFrame,
    keys: Sequence[str],
    zone: str | None = None,
    escape_separator: bool = False,
    allow_float: bool = False,
    hash_column: str = KEY_HASH,
) -> DataFrame:
    """Add the SHA-1 of the key string; a built-in expression, computed inside codegen."""
    return df.withColumn(
        hash_column, F.sha1(key_string(df, keys, zone, escape_separator, allow_float))
    )
