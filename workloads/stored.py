"""Writes, reads, publishing and repair over stores built from the tables."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import (
    DatasetSpec,
    SeriesStore,
    change_feed,
    check_consistency,
    consolidate_months,
    publish,
    register_extractor,
    register_normalizer,
    repair,
    run_ingest,
    stream_ingest,
)
from tidemark.functions.labels import version_of_path
from tidemark.operators.delta import delta, rebuild_index as distinct_keys
from tidemark.operators.enrich import enrich
from tidemark.plans import reads
from tidemark.sources.local import local_rows
from tidemark.sources.paths import remove_path
from tidemark.sources.snapshots import fingerprint_files
from tidemark.sources.tabular import read_manifest_json
from tidemark.store import latest_month_status
from workloads import sql as q
from workloads.registry import query
from workloads.views import (
    ORDER_KEYS,
    ORDERS,
    SNAPSHOT_ENDS,
    VERSIONS,
    ZONE,
    build_order_store,
    cents,
    dirty_observations,
    line_observations,
    order_observations,
    order_snapshot,
    order_store,
    run_time,
    scratch,
    table,
    time_text,
)


def _rows(df: DataFrame) -> DataFrame:
    return df.select(
        "order_key", "version", "internal_series_code", "value", time_text("obs_time").alias("obs_time")
    )


# ---- reads -------------------------------------------------------------------------------


@query(q.stored_rows("year = 1998 AND month = 3"))
def events_for_month(spark, sf_dir):
    return _rows(reads.events_for_month(order_store(spark, sf_dir), 1998, 3))


@query(q.stored_rows("year = 1999 AND month = 6 AND internal_series_code = '1-URGENT'"))
def read_series_month(spark, sf_dir):
    return _rows(reads.read_series_month(order_store(spark, sf_dir), "1-URGENT", 1999, 6))


@query(q.stored_rows("year = 1999 AND month = 6"))
def read_month(spark, sf_dir):
    return _rows(reads.read_month(order_store(spark, sf_dir), 1999, 6))


@query(q.stored_rows("year = 1996"))
def read_year(spark, sf_dir):
    return _rows(reads.read_year(order_store(spark, sf_dir), 1996))


@query(q.stored_rows("year = 2001 AND month BETWEEN 5 AND 7"))
def read_last_n_months(spark, sf_dir):
    return _rows(reads.read_last_n_months(order_store(spark, sf_dir), 3, date(2001, 7, 31)))


@query(q.stored_rows("TRUE"))
def full_history(spark, sf_dir):
    return _rows(reads.full_history(order_store(spark, sf_dir)))


@query(q.stored_rows(f"version >= '{VERSIONS[1]}'"))
def last_n_versions(spark, sf_dir):
    return _rows(reads.last_n_versions(order_store(spark, sf_dir), 2))


@query(q.stored_rows(f"version = '{VERSIONS[1]}'"))
def version_delta(spark, sf_dir):
    return _rows(reads.version_delta(order_store(spark, sf_dir), VERSIONS[1]))


@query(q.stored_rows(f"version <= '{VERSIONS[1]}'"))
def as_of_version(spark, sf_dir):
    return _rows(reads.as_of_version(order_store(spark, sf_dir), VERSIONS[1], list(ORDER_KEYS)))


@query(q.stored_rows("year = 1998 AND month = 1"))
def audit_month(spark, sf_dir):
    return _rows(reads.audit_month(order_store(spark, sf_dir), 1998, 1))


@query(q.stored_rows("year = 1999 AND month = 6") + " ORDER BY obs_time, order_key LIMIT 10")
def preview_month(spark, sf_dir):
    month = reads.read_month(order_store(spark, sf_dir), 1999, 6)
    return _rows(reads.preview(month, ["obs_time", "order_key"]))


# ---- manifests ---------------------------------------------------------------------------


@query(
    f"""WITH {q.OBS_O} SELECT '{VERSIONS[1]}' AS version,
        COUNT(*) FILTER (version = '{VERSIONS[1]}') AS rows_added, COUNT(*) AS rows_total,
        {q.time_text(f"MIN(obs_time) FILTER (version = '{VERSIONS[1]}')")} AS min_obs_time,
        {q.time_text('MAX(obs_time)')} AS max_obs_time, 'obs_time,order_key' AS key_columns
    FROM obs_o WHERE version <= '{VERSIONS[1]}'"""
)
def manifest_lookup(spark, sf_dir):
    return reads.manifest_lookup(order_store(spark, sf_dir), VERSIONS[1]).select(
        "version",
        F.col("outputs.rows_added_this_version").alias("rows_added"),
        F.col("outputs.rows_total").alias("rows_total"),
        time_text("outputs.min_obs_time").alias("min_obs_time"),
        time_text("outputs.max_obs_time").alias("max_obs_time"),
        F.array_join("index.key_columns", ",").alias("key_columns"),
    )


_SUMMARY = f"""WITH {q.OBS_O} SELECT version, COUNT(*) AS rows_added,
    CAST(SUM(COUNT(*)) OVER (ORDER BY version) AS BIGINT) AS rows_total FROM obs_o GROUP BY version"""


@query(_SUMMARY)
def manifest_summary(spark, sf_dir):
    return reads.manifest_summary(order_store(spark, sf_dir))


@query(f"WITH {q.OBS_O} SELECT DISTINCT version FROM obs_o ORDER BY version")
def version_history(spark, sf_dir):
    return reads.version_history(order_store(spark, sf_dir))


@query(f"WITH {q.OBS_O} SELECT 'orders' AS dataset_id, MAX(version) AS current_version FROM obs_o")
def current_version(spark, sf_dir):
    return order_store(spark, sf_dir).pointer()


@query(f"SELECT {q.time_text('MAX(o_orderdate)')} AS max_obs_time FROM orders")
def latest_watermark(spark, sf_dir):
    return reads.latest_watermark(order_store(spark, sf_dir)).select(
        time_text("max_obs_time").alias("max_obs_time")
    )


@query(
    f"""WITH {q.OBS_O} SELECT year, month, string_agg(DISTINCT version, ',' ORDER BY version) AS versions,
        COUNT(DISTINCT version) AS event_count FROM obs_o GROUP BY year, month"""
)
def month_version_index(spark, sf_dir):
    index = reads.month_version_index(order_store(spark, sf_dir))
    return index.withColumn("versions", F.array_join("versions", ","))


@query(
    f"""WITH {q.OBS_O}, v AS (SELECT DISTINCT version FROM obs_o)
    SELECT 'DATASET_UPDATED' AS type, 'orders' AS dataset_id, version,
        'orders/manifest_files/' || version || '/manifest.json' AS manifest_pointer, 'orders' AS group_id,
        sha256('orders/manifest_files/' || version || '/manifest.json') AS deduplication_id
    FROM v WHERE version > '{VERSIONS[0]}'""",
    name="change_feed",
)
def change_notices(spark, sf_dir):
    return change_feed(order_store(spark, sf_dir).manifests(), VERSIONS[0]).drop("timestamp")


@query(f"SELECT dataset_id, version, rows_added, rows_total FROM ({_SUMMARY}), (SELECT 'orders' AS dataset_id)")
def manifest_files(spark, sf_dir):
    """The JSON manifests of the versions."""
    store = order_store(spark, sf_dir)
    return read_manifest_json(spark, store.path("manifest_files", "*", "manifest.json")).select(
        "dataset_id",
        "version",
        F.col("outputs.rows_added_this_version").alias("rows_added"),
        F.col("outputs.rows_total").alias("rows_total"),
    )


@query(f"WITH {q.OBS_O} SELECT DISTINCT year, month, 'completed' AS status FROM obs_o")
def month_status(spark, sf_dir):
    return latest_month_status(order_store(spark, sf_dir).month_status_log()).drop("dataset_id")


# ---- key index ---------------------------------------------------------------------------


@query(
    f"""SELECT {q.VERSION} AS version, COUNT(DISTINCT {q.STORED_HASH}) AS keys,
        MIN({q.STORED_HASH}) AS first_key, MAX({q.STORED_HASH}) AS last_key FROM orders GROUP BY 1"""
)
def key_index_state(spark, sf_dir):
    return (
        order_store(spark, sf_dir)
        .index()
        .groupBy("version")
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.min("key_hash").alias("first_key"),
            F.max("key_hash").alias("last_key"),
        )
    )


@query(f"SELECT DISTINCT {q.STORED_HASH} AS key_hash FROM orders")
def rebuild_index(spark, sf_dir):
    """All keys again, from the stored events."""
    return distinct_keys(order_store(spark, sf_dir).events(), ORDER_KEYS, ZONE)


@query(
    """SELECT TRUE AS consistent, COUNT(*) AS expected, COUNT(*) AS actual, 'within tolerance' AS reason
    FROM orders"""
)
def index_consistency(spark, sf_dir):
    return check_consistency(order_store(spark, sf_dir))


@query(
    f"""SELECT 1 AS generation, COUNT(DISTINCT {q.STORED_HASH}) AS keys, TRUE AS consistent FROM orders"""
)
def repair_index(spark, sf_dir):
    """A store of its own that lost part of its index, which a repair finds and rebuilds."""
    store = build_order_store(spark, sf_dir, scratch(spark))
    remove_path(spark, store.path("key_index", "generation=0", f"version={VERSIONS[1]}"))
    repair(store, ZONE)
    report = check_consistency(store).select(F.col("actual").alias("keys"), "consistent")
    return report.withColumn("generation", F.lit(store.index_generation()))


# ---- writes ------------------------------------------------------------------------------

_BY_MONTH = f"""WITH {q.OBS_O} SELECT year, month, COUNT(*) AS n, {q.cents('value')} AS total_cents,
    MIN(order_key) AS first_order, MAX(order_key) AS last_order FROM obs_o GROUP BY year, month"""


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        cents("value").alias("total_cents"),
        F.min("order_key").alias("first_order"),
        F.max("order_key").alias("last_order"),
    )


@query(_BY_MONTH)
def write_events_roundtrip(spark, sf_dir):
    store, rows = SeriesStore(spark, scratch(spark), "orders"), order_observations(spark, sf_dir)
    store.write_events("v1", rows)
    return _by_month(store.read_written("v1", rows.schema))


@query("SELECT c_custkey AS customer, c_acctbal AS value, 'v1' AS version FROM customer")
def write_events_undated(spark, sf_dir):
    store = SeriesStore(spark, scratch(spark), "balances")
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS customer", "c_acctbal AS value")
    publish(store, rows, "v1", ["customer"], expected_current=None)
    return store.undated_events().select("customer", "value", "version")


@query(_BY_MONTH)
def projection_roundtrip(spark, sf_dir):
    return _by_month(order_store(spark, sf_dir).projections())


@query(
    f"""WITH {q.OBS_O}, two AS (SELECT CASE WHEN obs_time < '1998-01-01' THEN '{VERSIONS[0]}' ELSE
        '{VERSIONS[1]}' END AS version FROM obs_o)
    SELECT version, COUNT(*) AS rows_added, CAST(SUM(COUNT(*)) OVER (ORDER BY version) AS BIGINT) AS rows_total
    FROM two GROUP BY version"""
)
def publish_two_versions(spark, sf_dir):
    """Publish, publish more, and one attempt with an outdated idea of the current version."""
    store = SeriesStore(spark, scratch(spark), "orders")
    expected = None
    for number, rows in ((0, order_snapshot(spark, sf_dir, 0)), (1, order_observations(spark, sf_dir))):
        added = delta(rows, store.index(), ORDER_KEYS, ZONE)
        stamped = enrich(added, ORDERS, VERSIONS[number], run_time(number))
        publish(store, stamped, VERSIONS[number], ORDER_KEYS, expected, zone=ZONE)
        publish(store, stamped, VERSIONS[2], ORDER_KEYS, expected, zone=ZONE)
        expected = VERSIONS[number]
    return reads.manifest_summary(store)


class _Overtaken(SeriesStore):
    """A store in which another writer commits just before the first commit of this one."""

    other = None

    def append_manifest(self, *args, **kwargs):
        other, self.other = self.other, None
        if other:
            other()
        return super().append_manifest(*args, **kwargs)


@query(
    f"""SELECT o_orderkey AS order_key, o_orderpriority AS internal_series_code, o_totalprice AS value,
        CASE WHEN o_orderdate < '{SNAPSHOT_ENDS[1]}' THEN '{VERSIONS[0]}' ELSE '{VERSIONS[1]}' END AS version,
        {q.time_text('o_orderdate')} AS obs_time
    FROM orders"""
)
def publish_by_two_writers(spark, sf_dir):
    """Two writers start from nothing with overlapping rows; the one that commits second leaves
    out what the first added."""
    store = _Overtaken(spark, scratch(spark), "orders")
    early = order_snapshot(spark, sf_dir, 1)
    late = order_observations(spark, sf_dir).where(F.col("obs_time") >= F.lit(SNAPSHOT_ENDS[0]).cast("timestamp_ntz"))

    def commit(at: SeriesStore, rows: DataFrame, number: int) -> None:
        publish(at, enrich(rows, ORDERS, VERSIONS[number], run_time(number)), VERSIONS[number], ORDER_KEYS, None, zone=ZONE)

    store.other = lambda: commit(SeriesStore(spark, store.base.rpartition("/")[0], "orders"), early, 0)
    commit(store, late, 1)
    return _rows(store.events())


@query(
    f"""WITH {q.OBS_O} SELECT version, COUNT(*) AS n, {q.cents('value')} AS total_cents FROM obs_o
    GROUP BY version"""
)
def version_from_path(spark, sf_dir):
    """Event files in a foreign layout; the version is read off the file path."""
    root = scratch(spark)
    for number, version in enumerate(VERSIONS):
        start = F.lit(("1900-01-01", "1998-01-01", "2000-01-01")[number]).cast("timestamp_ntz")
        rows = order_snapshot(spark, sf_dir, number).where(F.col("obs_time") >= start)
        rows.write.parquet(f"{root}/events/{version}/data")
    files = spark.read.schema(order_observations(spark, sf_dir).schema).parquet(f"{root}/events/*/data")
    return (
        files.withColumn("version", version_of_path(F.col("_metadata.file_path")))
        .groupBy("version")
        .agg(F.count(F.lit(1)).alias("n"), cents("value").alias("total_cents"))
    )


@query(_BY_MONTH)
def ingest_snapshots(spark, sf_dir):
    """Three whole runs over growing snapshots, seen through the read model."""
    return _by_month(build_order_store(spark, sf_dir, scratch(spark)).projections())


@query(
    f"""WITH {q.OBS_O} SELECT version, COUNT(*) AS n, {q.cents('value')} AS total_cents, slices_read FROM (
        SELECT CASE WHEN version = '{VERSIONS[0]}' THEN version ELSE '{VERSIONS[1]}' END AS version, value,
               CASE WHEN version = '{VERSIONS[0]}' THEN 8 ELSE 1 END AS slices_read
        FROM obs_o WHERE version = '{VERSIONS[0]}' OR order_key % 8 = 3) GROUP BY version, slices_read"""
)
def ingest_changed_files(spark, sf_dir):
    """Eight landed folders, of which one is replaced: only its files are read."""
    root = scratch(spark)
    landing, columns = f"{root}/landing", order_observations(spark, sf_dir).schema
    in_slices = order_snapshot(spark, sf_dir, 0).withColumn("slice", F.col("order_key") % 8)
    in_slices.write.partitionBy("slice").parquet(landing)

    counts = []

    def read(paths):
        slices = {path.split("/")[-2] for path in paths} if paths else range(8)
        counts.append({"version": VERSIONS[len(counts)], "slices_read": len(slices)})
        return spark.read.schema(columns).parquet(*(paths or [landing]))

    for number in range(2):
        if number:
            whole = order_observations(spark, sf_dir).where("order_key % 8 = 3")
            whole.write.mode("overwrite").parquet(f"{landing}/slice=3")
        files = fingerprint_files(spark, landing, "*.parquet")
        run_ingest(
            spark, ORDERS, read, f"{root}/store", run_time=run_time(number), sources=files, watermark="off"
        )
    asked = local_rows(spark, counts, T.StructType().add("version", "string").add("slices_read", "integer"))
    events = SeriesStore(spark, f"{root}/store", "orders").events()
    added = events.groupBy("version").agg(F.count(F.lit(1)).alias("n"), cents("value").alias("total_cents"))
    return added.join(asked, "version")


@query(
    f"""WITH {q.OBS_O} SELECT COUNT(*) AS n, {q.cents('value')} AS total_cents,
        COUNT(DISTINCT {q.STORED_HASH.replace('o_orderdate', 'obs_time').replace('o_orderkey', 'order_key')}) AS keys
    FROM obs_o"""
)
def streamed_ingest(spark, sf_dir):
    """The snapshots as landed files, one stream over them; repeats are dropped by the index."""
    root = scratch(spark)
    for number in range(3):
        order_snapshot(spark, sf_dir, number).write.mode("append").parquet(f"{root}/landing")
    stream = (
        spark.readStream.schema(order_observations(spark, sf_dir).schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{root}/landing")
    )
    origin = datetime(2024, 1, 1, tzinfo=timezone.utc)
    writer = stream_ingest(stream, ORDERS, f"{root}/store", f"{root}/checkpoint", origin)
    writer.trigger(availableNow=True).start().awaitTermination()
    store = SeriesStore(spark, f"{root}/store", "orders")
    keys = store.index().agg(F.count(F.lit(1)).alias("keys"))
    return store.projections().agg(
        F.count(F.lit(1)).alias("n"), cents("value").alias("total_cents")
    ).select("*", keys.scalar().alias("keys"))


_TOTALS = f"""WITH {q.OBS_O} SELECT COUNT(*) AS n, COUNT(*) AS events, {q.cents('value')} AS total_cents FROM obs_o"""


@query(_TOTALS)
def stream_after_load(spark, sf_dir):
    """A first load whose run time is later than the stream's origin, the next snapshot as a
    stream, then the last one under a new checkpoint. No row is lost, none comes twice."""
    root = scratch(spark)
    late = datetime(2025, 1, 1, tzinfo=timezone.utc)
    run_ingest(spark, ORDERS, order_snapshot(spark, sf_dir, 0), f"{root}/store", run_time=late)
    for number in (1, 2):
        order_snapshot(spark, sf_dir, number).write.parquet(f"{root}/landing-{number}")
        stream = spark.readStream.schema(order_observations(spark, sf_dir).schema).parquet(f"{root}/landing-{number}")
        origin = datetime(2024, 1, 1, tzinfo=timezone.utc)
        writer = stream_ingest(stream, ORDERS, f"{root}/store", f"{root}/checkpoint-{number}", origin)
        writer.trigger(availableNow=True).start().awaitTermination()
    store = SeriesStore(spark, f"{root}/store", "orders")
    events = store.events().agg(F.count(F.lit(1)).alias("events"))
    return store.projections().agg(F.count(F.lit(1)).alias("n"), cents("value").alias("total_cents")).select(
        "*", events.scalar().alias("events")
    )


@query(_BY_MONTH)
def repair_months(spark, sf_dir):
    """Runs that ended before their read model was built, and a repair."""
    root = scratch(spark)
    for number in range(3):
        run_ingest(
            spark, ORDERS, order_snapshot(spark, sf_dir, number), root, run_time=run_time(number), consolidate=False
        )
    store = SeriesStore(spark, root, "orders")
    repair(store, ZONE)
    return _by_month(store.projections())


LINE_KEYS = ("obs_time", "internal_series_code")


@query(
    f"""WITH {q.OBS_L}, versioned AS (
        SELECT *, CASE WHEN l.version <= 'v2' THEN 'v1' WHEN l.version <= 'v4' THEN 'v2' ELSE 'v3' END AS published
        FROM obs_l l)
    SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, published AS version, value, order_key
    FROM versioned QUALIFY row_number() OVER (PARTITION BY internal_series_code, obs_time
        ORDER BY published DESC, value DESC, order_key DESC) = 1"""
)
def store_dedup(spark, sf_dir):
    """Line items keyed by series and ship date, in three versions: most keys come in all of
    them, and many times in each; the read model has the latest row of each key."""
    store = SeriesStore(spark, scratch(spark), "lines")
    lines = line_observations(spark, sf_dir)
    parts = {"v1": ("v1", "v2"), "v2": ("v3", "v4"), "v3": ("v5", "v6", "v7")}
    expected = None
    for version, numbers in parts.items():
        rows = lines.where(F.col("version").isin(*numbers)).select(*LINE_KEYS, "value", "order_key")
        publish(store, rows.withColumn("version", F.lit(version)), version, LINE_KEYS, expected)
        expected = version
    consolidate_months(store, LINE_KEYS)
    return store.projections().select(
        "internal_series_code", time_text("obs_time").alias("obs_time"), "version", "value", "order_key"
    )


@query(
    f"""WITH {q.OBS_L}
    SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, version, value, order_key
    FROM obs_l QUALIFY row_number() OVER (PARTITION BY internal_series_code, obs_time
        ORDER BY version DESC, value DESC, order_key DESC) = 1"""
)
def merged_read_model(spark, sf_dir):
    """Line items in seven versions, the read model merged after each: it reads what was
    published last and its own rows, and has the latest row of each key among all of them."""
    store = SeriesStore(spark, scratch(spark), "lines")
    lines = line_observations(spark, sf_dir).select(*LINE_KEYS, "value", "order_key", "version")
    expected = None
    for version in (f"v{n}" for n in range(1, 8)):
        result = publish(store, lines.where(F.col("version") == version), version, LINE_KEYS, expected)
        consolidate_months(store, LINE_KEYS, result.months)
        expected = version if result.published else expected
    return store.projections().select(
        "internal_series_code", time_text("obs_time").alias("obs_time"), "version", "value", "order_key"
    )



@query(
    f"""WITH {q.OBS_O}, marks AS (
        SELECT internal_series_code, MAX(obs_time) AS mark FROM obs_o WHERE obs_time < '1998-01-01' GROUP BY ALL)
    SELECT order_key, value FROM obs_o JOIN marks USING (internal_series_code) WHERE obs_time > mark"""
)
def ingest_per_series(spark, sf_dir):
    """The rows a second run adds when each series has its own watermark."""
    root = scratch(spark)
    for number, rows in ((0, order_snapshot(spark, sf_dir, 0)), (1, order_observations(spark, sf_dir))):
        run_ingest(spark, ORDERS, rows, root, run_time=run_time(number), watermark="series")
    store = SeriesStore(spark, root, "orders")
    return reads.version_delta(store, VERSIONS[1]).select("order_key", "value")


@query(
    f"""WITH {q.DIRTY}, mark AS (
        SELECT MAX(obs_time) AS mark FROM dirty WHERE obs_time < '2024-01-15' AND value IS NOT NULL)
    SELECT COUNT(*) AS rows_read, COUNT(*) FILTER (obs_time IS NULL) AS rejected_time,
        COUNT(*) FILTER (obs_time IS NOT NULL AND value IS NULL) AS rejected_value,
        COUNT(*) FILTER (value IS NOT NULL AND obs_time <= mark) AS not_newer, CAST(0 AS BIGINT) AS known,
        COUNT(*) FILTER (value IS NOT NULL AND obs_time > mark) AS added FROM dirty, mark"""
)
def ingest_counts(spark, sf_dir):
    """What became of the rows of a dirty source in the second of two runs."""
    spec = DatasetSpec("dirty", ("obs_time", "event_id"), frequency="D")
    root, rows = scratch(spark), dirty_observations(spark, sf_dir)
    run_ingest(spark, spec, rows.where("obs_time < '2024-01-15'"), root, run_time=run_time(0))
    result = run_ingest(spark, spec, rows, root, run_time=run_time(1), count_rows=True)
    names = ("rows_read", "rejected_time", "rejected_value", "not_newer", "known", "added")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    return local_rows(spark, [{n: getattr(result.counts, n) for n in names}], schema)


@query(
    f"""WITH {q.OBS_O} SELECT 'csv' AS form, COUNT(*) AS n, {q.cents('value')} AS total_cents FROM obs_o WHERE year = 1996
    UNION ALL SELECT 'parquet', COUNT(*), {q.cents('value')} FROM obs_o WHERE year = 1996"""
)
def export_roundtrip(spark, sf_dir):
    """A year of the read model, written as CSV and as Parquet and read back."""
    rows = reads.read_year(order_store(spark, sf_dir), 1996).select("order_key", "value")
    folder = scratch(spark)
    csv, parquet = (reads.export(rows, f"{folder}/year.{form}") for form in ("csv", "parquet"))
    back = {
        "csv": spark.read.option("header", True).schema(rows.schema).csv(csv),
        "parquet": spark.read.schema(rows.schema).parquet(parquet),
    }
    totals = [
        df.agg(F.count(F.lit(1)).alias("n"), cents("value").alias("total_cents")).select(F.lit(form).alias("form"), "*")
        for form, df in back.items()
    ]
    return totals[0].union(totals[1])


@query(
    f"""SELECT o_orderkey AS order_key, CAST(o_custkey AS DOUBLE) AS value, 'CUSTOMER' AS internal_series_code,
        {q.time_text("o_orderdate + INTERVAL 1 DAY")} AS obs_time FROM orders"""
)
def ingest_with_plugin(spark, sf_dir):
    """An extractor and a normaliser of one's own in a whole run."""
    register_extractor(
        "customers",
        lambda spec, df: df.select(
            F.col("o_orderdate").alias("obs_time"),
            F.col("o_custkey").cast("double").alias("value"),
            F.lit("CUSTOMER").alias("internal_series_code"),
            F.col("o_orderkey").alias("order_key"),
        ),
    )
    register_normalizer("customers", lambda spec, df: df.withColumn("obs_time", F.expr("obs_time + INTERVAL 1 DAY")))
    spec = DatasetSpec("customers", ("obs_time", "order_key"), frequency="D", plugin="customers")
    root = scratch(spark)
    run_ingest(spark, spec, table(spark, sf_dir, "orders"), root, run_time=run_time(0))
    return SeriesStore(spark, root, "customers").projections().select(
        "order_key", "value", "internal_series_code", time_text("obs_time").alias("obs_time")
    )
