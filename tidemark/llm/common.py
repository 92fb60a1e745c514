"""What several operators share: words, row identity, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.paths import remove_path

# A word is a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def without_spaces(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS, "")


def shared_folder(spark: SparkSession) -> str:
    """A new folder where the session keeps checkpoints. Without such a setting only a local
    master gets one of its own, since other executors could not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, and lost executors cost
    a read, not the work before."""
    path = folder or shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one operator, below one folder, each removed by its owner
    as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self._number = spark, shared_folder(spark), 0
        self._paths: dict[int, tuple[DataFrame | None, str]] = {}

    def table(self, df: DataFrame) -> DataFrame:
        self._number += 1
        path = f"{self.folder}/{self._number}"
        rows = written(df, path)
        self._paths[id(rows)] = (rows, path)
        return rows

    def subfolder(self) -> str:
        """For what writes tables by itself; goes with the rest in ``keep_only``."""
        self._number += 1
        path = f"{self.folder}/{self._number}"
        self._paths[-self._number] = (None, path)
        return path

    def owns(self, rows: DataFrame) -> bool:
        return id(rows) in self._paths

    def remove(self, *tables: DataFrame) -> None:
        for rows in tables:
            remove_path(self.spark, self._paths.pop(id(rows))[1])

    def keep_only(self, *tables: DataFrame) -> None:
        """Removes all tables but those that the result still reads."""
        kept = {id(rows) for rows in tables}
        for key in [k for k in self._paths if k not in kept]:
            remove_path(self.spark, self._paths.pop(key)[1])
