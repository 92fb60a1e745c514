"""Column layouts of every stored table, as explicit Spark schemas.

Reads always pass one of these, so no job infers a schema or opens footers to
find one, and partition columns get the declared type instead of a guessed one.
"""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = "internal_series_code"
KEY_HASH = "key_hash"

OBSERVATION = T.StructType(
    [
        T.StructField("obs_time", T.TimestampNTZType()),
        T.StructField("value", T.DoubleType()),
        T.StructField(SERIES, T.StringType()),
    ]
)

# The stored column order of an enriched row; other columns follow.
ENRICHED_EVENT = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("frequency", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("source_kind", T.StringType()),
        T.StructField("obs_time", T.TimestampNTZType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("value", T.DoubleType()),
        T.StructField(SERIES, T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("vintage_date", T.TimestampType()),
        T.StructField("quality_flag", T.StringType()),
    ]
)

MONTH_PARTITION = T.StructType(
    [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
)

KEY_INDEX = T.StructType(
    [
        T.StructField(KEY_HASH, T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

SERIES_MARK = T.StructType(
    [T.StructField(SERIES, T.StringType()), T.StructField("max_obs_time", T.TimestampNTZType())]
)

INDEX_GENERATION = T.StructType(
    [
        T.StructField("generation", T.IntegerType()),
        T.StructField("built_at_version", T.StringType()),
        T.StructField("rows_total", T.LongType()),
        T.StructField("zone", T.StringType()),
        T.StructField("escaped", T.BooleanType()),
        T.StructField("stamp", T.TimestampType()),
    ]
)

SOURCE_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)

# How a source file was last read: by which description and scope, for rows after which time
# (null: all), and for which version.
FILE_READ = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("how", T.StringType()),
        T.StructField("since", T.TimestampNTZType()),
        T.StructField("read_version", T.StringType()),
    ]
)

MONTH_STATS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("min_obs_time", T.TimestampNTZType()),
        T.StructField("max_obs_time", T.TimestampNTZType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        # The micro-batch a version was made from, if any.
        T.StructField(
            "batch",
            T.StructType([T.StructField("stream", T.StringType()), T.StructField("number", T.LongType())]),
        ),
        T.StructField(
            "source",
            T.StructType(
                [
                    T.StructField("sha256", T.StringType()),
                    T.StructField("file_count", T.LongType()),
                    T.StructField("size", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "outputs",
            T.StructType(
                [
                    T.StructField("data_prefix", T.StringType()),
                    T.StructField("months", T.ArrayType(MONTH_STATS)),
                    T.StructField("rows_total", T.LongType()),
                    T.StructField("rows_added_this_version", T.LongType()),
                    T.StructField("min_obs_time", T.TimestampNTZType()),
                    T.StructField("max_obs_time", T.TimestampNTZType()),
                    T.StructField("event_schema", T.StringType()),
                    T.StructField("table_schema", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "index",
            T.StructType(
                [
                    T.StructField("path", T.StringType()),
                    T.StructField("key_columns", T.ArrayType(T.StringType())),
                    T.StructField("hash_column", T.StringType()),
                    # How the keys were spelled; null in manifests that do not say.
                    T.StructField("zone", T.StringType()),
                    T.StructField("escaped", T.BooleanType()),
                ]
            ),
        ),
    ]
)

# The JSON form of a manifest, as other tools write it.
MANIFEST_JSON = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("source", T.StructType([T.StructField("files", T.ArrayType(SOURCE_FILE))])),
        T.StructField(
            "outputs",
            T.StructType(
                [
                    T.StructField("data_prefix", T.StringType()),
                    T.StructField("files", T.ArrayType(T.StringType())),
                    T.StructField("rows_total", T.LongType()),
                    T.StructField("rows_added_this_version", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "index",
            T.StructType(
                [
                    T.StructField("path", T.StringType()),
                    T.StructField("key_columns", T.ArrayType(T.StringType())),
                    T.StructField("hash_column", T.StringType()),
                ]
            ),
        ),
    ]
)

MONTH_STATUS = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("status", T.StringType()),
        # The newest version the month was, or is being, built from.
        T.StructField("version", T.StringType()),
        T.StructField("stamp", T.TimestampType()),
        # Why a rebuild failed.
        T.StructField("reason", T.StringType()),
    ]
)

SHEET_ROW = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("row_idx", T.IntegerType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)


def find_date_column(columns: list[str]) -> str | None:
    """Name of the date column: ``obs_time`` before ``obs_date``, else None."""
    return next((name for name in ("obs_time", "obs_date") if name in columns), None)


def merge_schemas(schemas: list[T.StructType]) -> T.StructType:
    """Union of fields by name; a name with two types is an error."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            known = fields.setdefault(field.name, field)
            if known.dataType != field.dataType:
                raise ValueError(
                    f"column {field.name!r} is {known.dataType.simpleString()} in one version "
                    f"and {field.dataType.simpleString()} in another"
                )
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])
