"""The rows of a micro-batch are dealt to all tasks before anything is done to them."""

from frames import at, observations

from tidemark import DatasetSpec, SeriesStore, stream_ingest

SPEC = DatasetSpec("d", ("obs_time", "internal_series_code"), frequency="D")


def test_a_micro_batch_of_one_row_group_is_spread(spark, root, monkeypatch):
    rows = [(f"2023-{m:02d}-{d:02d}", f"S{s}", 1.0) for m in range(1, 13) for d in range(1, 28) for s in range(20)]
    observations(spark, rows).coalesce(1).write.parquet(f"{root}/landing")
    parts, staged = [], SeriesStore.stage

    def stage(self, version, frame):
        parts.append("Rebalance" in frame._jdf.queryExecution().optimizedPlan().toString())
        return staged(self, version, frame)

    monkeypatch.setattr(SeriesStore, "stage", stage)
    for checkpoint in ("c1", "c2"):
        stream = spark.readStream.schema(observations(spark, rows[:1]).schema).parquet(f"{root}/landing")
        writer = stream_ingest(stream, SPEC, f"{root}/store", f"{root}/{checkpoint}", at("2024-01-01T00:00:00+00:00"))
        writer.trigger(availableNow=True).start().awaitTermination()
    store = SeriesStore(spark, f"{root}/store", "d")
    assert parts == [True] and store.events().count() == store.projections().count() == len(rows)
