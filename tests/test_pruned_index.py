"""The index a batch is compared with: pruned by a bitmap, with the rows of the plain join."""

import os

import pytest
from frames import at, daily
from pyspark.sql import functions as F

from tidemark import DatasetSpec, SeriesStore, run_ingest
from tidemark.operators.delta import relevant_index, without_known

SPEC = DatasetSpec("d", ("obs_time", "internal_series_code"), frequency="D")


def hashes(spark, numbers):
    return numbers.select(F.sha1(F.col("id").cast("string")).alias("key_hash"), "id")


def test_what_is_left_follows_the_batch(spark):
    index = hashes(spark, spark.range(200_000)).withColumn("version", F.lit("v1"))
    batch = hashes(spark, spark.range(199_900, 200_100)).union(hashes(spark, spark.range(199_990, 200_010)))
    kept = relevant_index(index, batch)
    assert kept.columns == index.columns
    assert 100 <= kept.count() < 100 + 200_000 * 220 / 16**4 * 1.5
    rows = lambda known: sorted(r.id for r in without_known(batch, known).collect())
    assert rows(kept) == rows(index) == sorted([*range(200_000, 200_100), *range(200_000, 200_010)])


@pytest.mark.parametrize("numbers", [(0, 0), (0, 1), (0, 5000)])
def test_every_match_is_kept(spark, numbers):
    index = hashes(spark, spark.range(5000))
    batch = hashes(spark, spark.range(*numbers))
    assert relevant_index(index, batch).join(batch.select("key_hash"), "key_hash", "left_semi").count() == batch.count()


def test_a_batch_too_large_for_a_bitmap_meets_the_whole_index(spark):
    index, batch = hashes(spark, spark.range(100)), hashes(spark, spark.range(50, 150))
    assert relevant_index(index, batch, most_bytes=100).count() == 100


@pytest.mark.parametrize("scope", ["off", "series"])
def test_runs_stage_their_batch_and_clean_up(spark, root, scope):
    run = lambda n, day: run_ingest(
        spark, SPEC, daily(spark, n), root, run_time=at(f"2024-01-0{day}T00:00:00+00:00"), watermark=scope
    )
    assert [run(30, 1).rows_added, run(40, 2).rows_added, run(40, 3).rows_added] == [30, 10, 0]
    store = SeriesStore(spark, root, "d")
    assert store.events().count() == 40 and not os.listdir(store.path("staging"))
