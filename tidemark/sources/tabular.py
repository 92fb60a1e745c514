"""CSV and Parquet drops, and tables that may not exist yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import MANIFEST_JSON
from tidemark.sources.local import no_rows
from tidemark.sources.paths import path_exists

_CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, **options
) -> DataFrame:
    """CSV with a declared schema; an unreadable cell is null, a short row is padded."""
    return (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .options(**options)
        .schema(schema)
        .csv(path)
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    skip_unreadable: bool = False,
) -> DataFrame:
    """A Parquet table, or an empty one of the same schema if the path is missing."""
    if not path_exists(spark, path):
        return no_rows(spark, schema)
    reader = spark.read.schema(schema)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.parquet(path)


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Manifests in JSON form, one document per file; missing or corrupt ones give no row."""
    if not path_exists(spark, path):
        return no_rows(spark, MANIFEST_JSON)
    marked = T.StructType([*MANIFEST_JSON.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(marked)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("multiLine", True)
        .json(path)
    )
    return rows.where(F.col(_CORRUPT).isNull() & F.col("version").isNotNull()).drop(_CORRUPT)
