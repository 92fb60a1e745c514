"""Commit order, rollback, conflicts, repair, month status, reads, streaming."""

import json
import os
from datetime import date, datetime, timezone

import pytest
from frames import at, daily, observations, sorted_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import (
    DatasetSpec,
    SeriesStore,
    change_feed,
    check_consistency,
    consolidate_months,
    publish,
    rebuild,
    register_extractor,
    register_normalizer,
    repair,
    run_ingest,
    stream_ingest,
)
from tidemark.plans import reads, registry
from tidemark.operators.watermark import narrow_scan
from tidemark.schema import merge_schemas
from tidemark.sources.tabular import read_manifest_json
from tidemark.store import latest_month_status

KEYS = ("obs_time", "internal_series_code")
SPEC = DatasetSpec("d", KEYS, frequency="D")
V1, V2, V3 = "2024-01-01T00-00-00", "2024-01-02T00-00-00", "2024-01-03T00-00-00"


def months_frame(spark):
    """One reading in each of the last three months of 2022."""
    readings = {10: ("north", -4.25), 11: ("south", 0.5), 12: ("west", 18.75)}
    return observations(spark, [(f"2022-{m}-2{m % 10} 06:40:00", s, v) for m, (s, v) in readings.items()])


def put(store, rows, version, expected=None, **options):
    return publish(store, rows, version, KEYS, expected, **options)


def test_one_directory_per_month_and_body_without_partition_columns(spark, root):
    store = SeriesStore(spark, root, "d")
    store.write_events(V1, months_frame(spark))
    base = store.path("events", f"version={V1}")
    assert sorted(os.listdir(f"{base}/year=2022")) == ["month=10", "month=11", "month=12"]
    part = next(f for f in os.listdir(f"{base}/year=2022/month=10") if f.endswith(".parquet"))
    assert spark.read.parquet(f"{base}/year=2022/month=10/{part}").columns == ["obs_time", "value", "internal_series_code"]


def test_events_are_invisible_until_the_manifest(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    store.write_events(V2, observations(spark, [("2024-04-01", "A", 1.0)]))
    assert store.events().count() == 3 and store.current_version() == V1
    assert put(store, observations(spark, [("2024-04-01", "A", 1.0)]), V2, V1).rows_total == 4
    assert store.events().count() == 4
    with pytest.raises(ValueError, match="already published"):
        store.write_events(V2, months_frame(spark))


@pytest.mark.parametrize("step", ["stats_of", "write_index", "append_manifest"])
def test_a_failed_publish_leaves_nothing(spark, root, monkeypatch, step):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)

    def broken(*args, **kwargs):
        raise OSError("disk gone")

    monkeypatch.setattr(store, step, broken)
    with pytest.raises(OSError, match="disk gone"):
        put(store, observations(spark, [("2024-04-01", "A", 1.0)]), V2, V1)
    monkeypatch.undo()
    assert store.current_version() == V1 and store.events().count() == store.index().count() == 3
    assert not os.path.exists(store.path("events", f"version={V2}"))
    assert put(store, observations(spark, [("2024-04-01", "A", 1.0)]), V2, V1).published


def test_publish_conflict_order_and_empty_delta(spark, root):
    store = SeriesStore(spark, root, "d")
    assert not put(store, months_frame(spark).limit(0), V1).published
    assert store.current_version() is None
    assert put(store, months_frame(spark), V2).published
    lost = put(store, months_frame(spark), V3, expected=None)
    assert not lost.published and V2 in lost.reason
    with pytest.raises(ValueError, match="not later"):
        put(store, months_frame(spark), V1, V2)
    with pytest.raises(ValueError, match="label"):
        put(store, months_frame(spark), "../x", V2)


def test_known_keys_are_not_counted_twice(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    again = put(store, months_frame(spark).union(observations(spark, [("2024-03-16", "C", 1.0)])), V2, V1)
    assert (again.rows_added, again.rows_total) == (4, 4)
    assert store.index().count() == 4


def test_undated_rows(spark, root):
    store = SeriesStore(spark, root, "d")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "col1 bigint")
    got = publish(store, rows, V1, ["col1"], None)
    assert (got.rows_added, got.rows_total, got.months) == (3, 3, ())
    assert sorted_rows(store.undated_events().select("col1", "version")) == [(1, V1), (2, V1), (3, V1)]
    assert os.listdir(store.path("events_undated")) == [f"version={V1}"]
    # A key without a time may repeat in any month, so its index rows carry none.
    assert store.index().where("year IS NOT NULL").count() == 0


def test_null_dates_in_a_dated_frame_are_kept(spark, root):
    store = SeriesStore(spark, root, "d")
    rows = observations(spark, [("2024-01-15", "A", 1.0), (None, "A", 2.0)])
    assert put(store, rows, V1).rows_added == 2
    assert store.events().where("year IS NULL").count() == 1


def test_columns_may_be_added_later(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    put(store, observations(spark, [("2024-04-01", "A", 1.0)]).withColumn("note", F.lit("n")), V2, V1)
    assert sorted(tuple(r) for r in store.events().groupBy("note").count().collect() if r.note) == [("n", 1)]
    assert store.events().count() == 4
    with pytest.raises(ValueError, match="note"):
        put(store, observations(spark, [("2024-05-01", "A", 1.0)]).withColumn("note", F.lit(1)), V3, V2)
    one, other = (T.StructType([T.StructField("x", t)]) for t in (T.LongType(), T.StringType()))
    with pytest.raises(ValueError):
        merge_schemas([one, other])


def test_lost_index_is_found_and_rebuilt(spark, root):
    run_ingest(spark, SPEC, daily(spark, 40), root, run_time=at("2024-01-01T00:00:00+00:00"))
    store = SeriesStore(spark, root, "d")
    before = sorted_rows(store.index().select("key_hash", "year", "month"))
    assert not repair(store)
    # Point at an empty generation, as after losing the index.
    store.append_generation(5, V1, 40)
    assert not check_consistency(store).first().consistent
    assert repair(store)
    assert store.index_generation() == 6
    assert sorted_rows(store.index().select("key_hash", "year", "month")) == before
    assert run_ingest(spark, SPEC, daily(spark, 41), root, run_time=at("2024-01-02T00:00:00+00:00")).rows_total == 41
    assert rebuild(store) and store.index().count() == 41
    assert not rebuild(SeriesStore(spark, root, "nothing"))


def test_month_status_life(spark, root):
    store = SeriesStore(spark, root, "d")
    assert latest_month_status(store.month_status_log()).count() == 0
    put(store, months_frame(spark), V1)
    assert consolidate_months(store, KEYS, [(2022, 10), (2030, 1)]) == [(2022, 10)]
    status = latest_month_status(store.month_status_log()).select("year", "month", "status")
    assert sorted_rows(status) == [(2022, 10, "completed"), (2030, 1, "in_progress")]
    assert consolidate_months(store, KEYS, only_incomplete=True) == [(2022, 11), (2022, 12)]
    assert consolidate_months(store, KEYS, only_incomplete=True) == []
    assert consolidate_months(store, KEYS) == [(2022, 10), (2022, 11), (2022, 12)]
    assert store.projections().count() == 3


def test_only_touched_months_are_rewritten(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    consolidate_months(store, KEYS)
    october = store.path("projections", "year=2022", "month=10")
    before = sorted(os.listdir(october))
    put(store, observations(spark, [("2022-11-30", "south", 1.0)]), V2, V1)
    consolidate_months(store, KEYS, [(2022, 11)])
    assert sorted(os.listdir(october)) == before
    assert store.projections().count() == 4


def test_reads(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    put(store, observations(spark, [("2022-11-30", "south", 5.0)]), V2, V1)
    consolidate_months(store, KEYS)
    assert reads.read_year(store, 2022).count() == 4
    assert reads.read_last_n_months(store, 2, date(2022, 12, 31)).count() == 3
    assert reads.read_last_n_months(store, 3, date(2022, 10, 31)).count() == 1
    assert reads.version_delta(store, V2).count() == 1 and reads.version_delta(store, "v0").count() == 0
    assert reads.as_of_version(store, V1).count() == 3
    assert reads.last_n_versions(store, 1).count() == 1
    assert [r.version for r in reads.audit_month(store, 2022, 11).collect()] == [V1, V2]
    index = {(r.year, r.month): (r.versions, r.event_count) for r in reads.month_version_index(store).collect()}
    assert index[(2022, 11)] == ([V1, V2], 2) and index[(2022, 12)] == ([V1], 1)
    with pytest.raises(ValueError, match="year and month"):
        reads.read_month(store, 2022, None)
    assert reads.events_for_month(store, 2022, 9).count() == 0
    opened = {f.split("/events/")[1].rsplit("/", 1)[0] for f in reads.events_for_month(store, 2022, 11).inputFiles()}
    assert opened == {f"version={v}/year=2022/month=11" for v in (V1, V2)}
    plan = store.index(months=[(2022, 11)])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year" in filters and "month" in filters and "version" in filters


@pytest.mark.parametrize("name, written", [("a.csv", "a.csv"), ("b.parquet", "b.parquet"), ("c.bin", "c.bin.csv")])
def test_export(spark, root, name, written):
    target = reads.export(months_frame(spark), f"{root}/{name}")
    assert target == f"{root}/{written}"
    back = spark.read.parquet(target) if written.endswith("parquet") else spark.read.option("header", True).csv(target)
    assert back.count() == 3 and back.columns == ["obs_time", "value", "internal_series_code"]


def test_change_feed(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    put(store, observations(spark, [("2024-04-01", "A", 1.0)]), V2, V1)
    feed = change_feed(store.manifests(), V1).collect()
    assert [(r.version, r.type) for r in feed] == [(V2, "DATASET_UPDATED")]
    with open(f"{root}/{feed[0].manifest_pointer}") as file:
        document = json.load(file)
    assert (document["version"], document["outputs"]["rows_total"]) == (V2, 4)
    assert [f.split("/d/")[1] for f in document["outputs"]["files"]] == [f"events/version={V2}/year=2024/month=04"]
    assert read_manifest_json(spark, f"{root}/d/manifest_files/*/manifest.json").count() == 2
    assert change_feed(store.manifests()).count() == 2


def test_registry(spark):
    spec = DatasetSpec("d", KEYS, extractor="mine", normalizer="mine")
    with pytest.raises(ValueError, match="no extractor named 'mine'"):
        registry.extractor_of(spec)
    register_extractor("mine", lambda s, df: df.limit(0))
    register_extractor("mine", lambda s, df: df)
    register_normalizer("mine", lambda s, df: df)
    rows = months_frame(spark)
    assert registry.extractor_of(spec)(spec, rows).count() == 3
    assert registry.normalizer_of(spec)(spec, rows).count() == 3
    with pytest.raises(ValueError, match="must name"):
        registry.extractor_of(DatasetSpec("d", KEYS, extractor=None))
    over = DatasetSpec("d", KEYS, extractor="wide", plugin="mine")
    assert registry.extractor_of(over) is registry.extractor_of(spec)
    with pytest.raises(ValueError):
        register_extractor("", lambda s, df: df)


def test_stream_of_snapshots_and_its_replay(spark, root):
    landing = f"{root}/landing"
    daily(spark, 40).write.parquet(f"{landing}")
    origin = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def drain(checkpoint):
        stream = spark.readStream.schema(daily(spark, 1).schema).option("maxFilesPerTrigger", 100).parquet(landing)
        writer = stream_ingest(stream, SPEC, f"{root}/store", f"{root}/{checkpoint}", origin)
        writer.trigger(availableNow=True).start().awaitTermination()

    drain("c1")
    store = SeriesStore(spark, f"{root}/store", "d")
    assert store.current_version() == V1 and store.projections().count() == 40
    daily(spark, 45).write.mode("append").parquet(landing)
    drain("c1")
    assert store.events().count() == 45 and store.manifests().count() == 2
    # A stream started anew sees all files again under the first labels: nothing is added.
    drain("c2")
    assert store.events().count() == 45 and store.manifests().count() == 2


def test_random_snapshots_keep_the_invariants(spark, root):
    import random

    dice, keys, moment = random.Random(7), set(), datetime(2024, 6, 1, tzinfo=timezone.utc)
    store = SeriesStore(spark, root, "d")
    for turn in range(3):
        rows = [
            (f"2024-{dice.randint(1, 3):02d}-{dice.randint(1, 28):02d}", dice.choice("ABC"), float(dice.randint(0, 9)))
            for _ in range(60)
        ]
        fresh = [r for r in rows if r[:2] not in keys]
        keys |= {r[:2] for r in rows}
        for repeat in range(2):
            result = run_ingest(
                spark, SPEC, observations(spark, rows), root, run_time=moment.replace(hour=turn, minute=repeat), watermark="off"
            )
            assert result.rows_added == (0 if repeat else len(fresh))
    assert store.index().count() == store.projections().count() == len(keys)
    history = store.events().select(F.date_format("obs_date", "yyyy-MM-dd"), "internal_series_code").distinct()
    assert set(map(tuple, history.collect())) == keys
    stored = sorted_rows(store.index().select("key_hash"))
    assert rebuild(store) and sorted_rows(store.index().select("key_hash")) == stored


def test_leftovers_of_failed_runs_stay_hidden_after_later_versions(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    left = observations(spark, [("2024-05-01", "A", 1.0)])
    store.write_events(V2, left)
    store.write_index(V2, store.read_written(V2, left.schema), KEYS, None, False, None)
    put(store, observations(spark, [("2024-06-01", "A", 1.0)]), V3, V1)
    assert store.versions() == [V1, V3]
    assert store.events().count() == store.index().count() == 4
    assert reads.last_n_versions(store, 1).count() == 1
    assert reads.last_n_versions(store, 5).count() == 4 and reads.last_n_versions(store, 0).count() == 0
    plan = store.events()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_reads_of_an_empty_store(spark, root):
    store = SeriesStore(spark, root, "d")
    for rows in (store.events(), store.index(), store.projections(), store.undated_events(), store.manifests()):
        assert rows.count() == 0
    assert store.current_version() is None and reads.last_n_versions(store, 3).count() == 0
    assert check_consistency(store).first().reason == "nothing published"


def test_repeated_keys_are_projected_once(spark, root):
    store = SeriesStore(spark, root, "d")
    put(store, months_frame(spark), V1)
    repeated = months_frame(spark).withColumn("value", F.col("value") + 100)
    put(store, repeated.union(observations(spark, [(None, "north", 5.0)])), V2, V1)
    assert consolidate_months(store, KEYS) == [(2022, 10), (2022, 11), (2022, 12)]
    assert sorted_rows(store.projections().select("value", "version")) == [(95.75, V2), (100.5, V2), (118.75, V2)]


def test_lost_index_rows_never_double_a_key(spark, root):
    first = run_ingest(spark, SPEC, daily(spark, 20), root, run_time=at("2024-01-01T00:00:00+00:00"))
    store = SeriesStore(spark, root, "d")
    lost = store.path("key_index", "generation=0", f"version={first.version}", "year=2020", "month=01")
    kept = spark.read.parquet(lost).limit(15).toPandas()
    spark.createDataFrame(kept).write.mode("overwrite").parquet(lost)
    assert not check_consistency(store).first().consistent
    # Without the check the five keys look new; the read model still has each key once.
    blind = run_ingest(
        spark, SPEC, daily(spark, 20), root, run_time=at("2024-01-02T00:00:00+00:00"), watermark="off", verify_index=False
    )
    assert blind.rows_added == 5
    assert store.projections().count() == store.projections().select("obs_time").distinct().count() == 20
    # A checked run corrects index and total.
    again = run_ingest(spark, SPEC, daily(spark, 21), root, run_time=at("2024-01-03T00:00:00+00:00"), watermark="off")
    assert (again.rows_added, again.rows_total) == (1, 21)
    assert check_consistency(store).first().consistent
    assert store.projections().count() == store.index().count() == store.rows_total() == 21


@pytest.mark.parametrize("way", ["run", "repair", "only_incomplete"])
def test_months_of_an_interrupted_run_are_rebuilt(spark, root, monkeypatch, way):
    files = spark.createDataFrame([("f", "h2", 1)], "path string, sha256 string, size bigint")
    run_ingest(spark, SPEC, daily(spark, 40), root, run_time=at("2024-01-01T00:00:00+00:00"))
    store = SeriesStore(spark, root, "d")

    def broken(*args, **kwargs):
        raise OSError("disk gone")

    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "write_projections", broken)
        with pytest.raises(OSError):
            run_ingest(spark, SPEC, daily(spark, 45), root, run_time=at("2024-01-02T00:00:00+00:00"), sources=files)
    assert store.events().count() == 45 and store.projections().count() == 40
    assert store.due_months() == [(2020, 2)]
    if way == "run":
        result = run_ingest(spark, SPEC, daily(spark, 45), root, run_time=at("2024-01-03T00:00:00+00:00"), sources=files)
        assert result.reason == "source unchanged" and result.mended_months == ((2020, 2),)
    elif way == "repair":
        assert repair(store)
    else:
        assert consolidate_months(store, KEYS, only_incomplete=True) == [(2020, 2)]
    assert store.projections().count() == 45 and not store.due_months()
    assert not repair(store)


def test_a_replayed_batch_finishes_what_its_first_attempt_left(spark, root, monkeypatch):
    landing, origin = f"{root}/landing", datetime(2024, 1, 1, tzinfo=timezone.utc)
    daily(spark, 12).write.parquet(landing)

    def drain(checkpoint):
        stream = spark.readStream.schema(daily(spark, 1).schema).parquet(landing)
        writer = stream_ingest(stream, SPEC, f"{root}/store", f"{root}/{checkpoint}", origin)
        writer.trigger(availableNow=True).start().awaitTermination()

    def broken(*args, **kwargs):
        raise OSError("disk gone")

    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "write_projections", broken)
        with pytest.raises(Exception, match="disk gone"):
            drain("c1")
    store = SeriesStore(spark, f"{root}/store", "d")
    assert store.events().count() == 12 and store.projections().count() == 0
    drain("c1")
    assert store.events().count() == store.projections().count() == 12 and store.manifests().count() == 1


def test_batches_are_never_taken_for_replays_of_others(spark, root):
    """A store loaded later than the stream's origin, then a second checkpoint: batch numbers
    and labels repeat, rows do not get lost."""
    run_ingest(spark, SPEC, daily(spark, 3), f"{root}/store", run_time=at("2025-01-01T00:00:00+00:00"))
    store = SeriesStore(spark, f"{root}/store", "d")
    for number, days in enumerate((8, 13)):
        daily(spark, days).write.parquet(f"{root}/landing-{number}")
        stream = spark.readStream.schema(daily(spark, 1).schema).parquet(f"{root}/landing-{number}")
        writer = stream_ingest(
            stream, SPEC, f"{root}/store", f"{root}/c-{number}", datetime(2024, 1, 1, tzinfo=timezone.utc)
        )
        writer.trigger(availableNow=True).start().awaitTermination()
        assert store.events().count() == store.projections().count() == days
    assert store.versions() == ["2025-01-01T00-00-00", "2025-01-01T00-00-01", "2025-01-01T00-00-02"]


@pytest.mark.parametrize("kind, pushed", [("timestamp_ntz", "GreaterThan(obs_time"), ("timestamp", "GreaterThan(obs_time"), ("date", "GreaterThanOrEqual(obs_time")])
def test_the_watermark_of_a_run_reaches_the_scan(spark, root, kind, pushed):
    spec = DatasetSpec("d", KEYS, frequency="D", timezone="America/Argentina/Buenos_Aires")
    typed = daily(spark, 60).withColumn("obs_time", F.col("obs_time").cast(kind))
    typed.write.parquet(f"{root}/source")
    cutoff = datetime(2020, 2, 10)
    rows = narrow_scan(spark.read.parquet(f"{root}/source"), cutoff, zone=spec.timezone)
    rows = registry.normalizer_of(spec)(spec, registry.extractor_of(spec)(spec, rows))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    run_ingest(spark, spec, spark.read.parquet(f"{root}/source").where("obs_time <= '2020-02-10'"), root, run_time=at("2024-01-01T00:00:00+00:00"))
    result = run_ingest(spark, spec, spark.read.parquet(f"{root}/source"), root, run_time=at("2024-01-02T00:00:00+00:00"))
    assert (result.rows_added, result.rows_total) == (19, 60)


def test_a_source_without_one_usable_row_fails_the_run(spark, root):
    rows = spark.createDataFrame(
        [("31/12/2024", "1", "S"), (None, "2", "S"), ("2024-01-01", "n/a", "S")],
        "obs_time string, value string, internal_series_code string",
    )
    with pytest.raises(ValueError, match="no row of 3 is usable: 2 without a readable time, 1 without"):
        run_ingest(spark, SPEC, rows, root, run_time=at("2024-01-01T00:00:00+00:00"))
    assert SeriesStore(spark, root, "d").current_version() is None
    good = rows.union(spark.createDataFrame([("2024-01-05", "4", "S")], rows.schema))
    result = run_ingest(spark, SPEC, good, root, run_time=at("2024-01-02T00:00:00+00:00"), count_rows=True)
    assert (result.counts.rows_read, result.counts.rejected_time, result.counts.rejected_value, result.counts.added) == (4, 2, 1, 1)
    nothing = run_ingest(spark, SPEC, rows.limit(0), root, run_time=at("2024-01-03T00:00:00+00:00"))
    assert nothing.reason == "no new rows"
