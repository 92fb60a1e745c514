"""Fingerprints, change detection, CSV, absent tables, JSON manifests."""

import hashlib
import json
import os

from frames import sorted_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fingerprint import combined_fingerprint, source_changes
from tidemark.operators.normalize import normalize
from tidemark.schema import KEY_INDEX
from tidemark.sources.snapshots import fingerprint_files, read_files
from tidemark.sources.tabular import read_csv, read_manifest_json, read_table

FILE = "path string, sha256 string, size bigint"


def test_fingerprint_of_files(spark, root):
    for name, text in (("a.csv", b"x,y\n"), ("b.csv", b"1"), ("empty.csv", b""), ("c.txt", b"no")):
        with open(os.path.join(root, name), "wb") as out:
            out.write(text)
    got = fingerprint_files(spark, root, "*.csv").select(F.substring_index("path", "/", -1), "sha256", "size")
    assert sorted_rows(got) == [
        ("a.csv", hashlib.sha256(b"x,y\n").hexdigest(), 4),
        ("b.csv", hashlib.sha256(b"1").hexdigest(), 1),
    ]
    listed = fingerprint_files(spark, root, "*.csv", by="listing")
    assert listed.count() == 2
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert read_files(spark, root, "*.txt").count() == 1


def test_combined_fingerprint(spark):
    one = spark.createDataFrame([("a", "h1", 3)], FILE)
    assert tuple(combined_fingerprint(one).first()) == ("h1", 1, 3)
    two = spark.createDataFrame([("a", "h1", 3), ("b", "h2", 4)], FILE)
    swapped = spark.createDataFrame([("b", "h2", 4), ("a", "h1", 3)], FILE)
    other = spark.createDataFrame([("a", "h2", 3), ("b", "h1", 4)], FILE)
    digest = combined_fingerprint(two).first()
    assert (digest.file_count, digest.size, len(digest.sha256)) == (2, 7, 64)
    assert combined_fingerprint(swapped).first().sha256 == digest.sha256
    assert combined_fingerprint(other).first().sha256 != digest.sha256
    assert combined_fingerprint(one.limit(0)).first().sha256 is None


def test_source_changes(spark):
    now = spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("c", "3", 1), ("d", "4", 1)], FILE)
    last = spark.createDataFrame([("a", "1", 1), ("b", "x", 1), ("d", None, 1), ("gone", "5", 1)], FILE)
    got = dict(tuple(r) for r in source_changes(now, last).select("path", "changed").collect())
    assert got == {"a": False, "b": True, "c": True, "d": True}
    assert source_changes(now, last, full_reload=True).where("changed").count() == 4


def test_csv_cells_that_cannot_be_read_are_null(spark, root):
    with open(os.path.join(root, "in.csv"), "w") as out:
        out.write("obs_time,value,internal_series_code\n2024-01-01,1.5,A\nbad,2,A\n2024-01-03,s/d,A\n2024-01-04,4\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("obs_time", "value", "internal_series_code")])
    rows = read_csv(spark, root, schema)
    assert rows.count() == 4
    got = normalize(rows).select(F.col("obs_time").cast("string"), "value", "internal_series_code").collect()
    assert [tuple(r) for r in got] == [("2024-01-01 00:00:00", 1.5, "A"), ("2024-01-04 00:00:00", 4.0, None)]


def test_absent_table_is_empty(spark, root):
    got = read_table(spark, root + "/nothing", KEY_INDEX)
    assert got.schema == KEY_INDEX and got.count() == 0


def test_unreadable_files_can_be_skipped(spark, root):
    spark.range(3).write.parquet(root + "/t")
    with open(root + "/t/part-broken.parquet", "wb") as out:
        out.write(b"not parquet")
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert read_table(spark, root + "/t", schema, skip_unreadable=True).count() == 3


def test_json_manifests(spark, root):
    manifest = {
        "dataset_id": "d", "version": "2024-01-01T00-00-00", "created_at": "2024-01-01T00:00:05Z",
        "source": {"files": [{"sha256": "abc", "size": 100}]},
        "outputs": {"data_prefix": "p", "files": ["f1", "f2"], "rows_total": 2, "rows_added_this_version": 2},
        "index": {"path": "i", "key_columns": ["obs_time"], "hash_column": "key_hash"},
    }
    with open(root + "/good.json", "w") as out:
        json.dump(manifest, out, indent=1)
    with open(root + "/bad.json", "w") as out:
        out.write("{not json")
    got = read_manifest_json(spark, root).collect()
    assert len(got) == 1
    assert got[0].outputs.rows_total == 2 and got[0].source.files[0].sha256 == "abc"
    assert read_manifest_json(spark, root + "/none").count() == 0
