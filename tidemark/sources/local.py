"""Small driver-side rows (specs, manifests, status) as DataFrames of known size."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_rows(
    spark: SparkSession, rows: Iterable[Mapping[str, object]], schema: T.StructType
) -> DataFrame:
    """Rows given as mappings. Through Arrow they become a local relation, whose size
    Spark knows when it picks a join, and which needs no Python worker."""
    table = pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return local_rows(spark, [], schema)
