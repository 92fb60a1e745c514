"""Delta, key index, deduplication and month aggregates over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import with_key_hash
from tidemark.operators import dedup, delta
from tidemark.operators.normalize import add_year_month
from tidemark.plans.consolidation import affected_months as distinct_months
from workloads import sql as q
from workloads.registry import query
from workloads.views import (
    ORDER_KEYS,
    event_observations,
    cents,
    line_observations,
    order_observations,
    order_snapshot,
    table,
    time_text,
)

EVENT_KEYS = ["obs_time", "internal_series_code"]


def _first_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.rebuild_index(order_snapshot(spark, sf_dir, 0), ORDER_KEYS)


# ---- delta -------------------------------------------------------------------------------


@query(f"SELECT o_orderkey AS order_key, {q.PLAIN_HASH} AS key_hash FROM orders")
def delta_first_run(spark, sf_dir):
    return delta.delta(order_observations(spark, sf_dir), None, ORDER_KEYS).select("order_key", "key_hash")


@query(
    f"""SELECT o_orderkey AS order_key, {q.PLAIN_HASH} AS key_hash FROM orders
    WHERE {q.PLAIN_HASH} NOT IN (SELECT {q.PLAIN_HASH} FROM orders WHERE o_orderdate < '1998-01-01')"""
)
def delta_incremental(spark, sf_dir):
    rows = delta.delta(order_observations(spark, sf_dir), _first_index(spark, sf_dir), ORDER_KEYS)
    return rows.select("order_key", "key_hash")


@query(
    f"""SELECT o_orderkey AS order_key, {q.PLAIN_HASH} AS key_hash FROM orders
    WHERE {q.PLAIN_HASH} NOT IN (SELECT {q.PLAIN_HASH} FROM orders)"""
)
def delta_idempotent(spark, sf_dir):
    orders = order_observations(spark, sf_dir)
    rows = delta.delta(orders, delta.rebuild_index(orders, ORDER_KEYS), ORDER_KEYS)
    return rows.select("order_key", "key_hash")


@query(
    f"""SELECT o_orderkey AS order_key, {q.PLAIN_HASH} AS key_hash FROM orders
    WHERE {q.PLAIN_HASH} IN (SELECT {q.PLAIN_HASH} FROM orders WHERE o_orderdate < '1998-01-01')"""
)
def existing_keys(spark, sf_dir):
    rows = delta.existing_keys(order_observations(spark, sf_dir), _first_index(spark, sf_dir), ORDER_KEYS)
    return rows.select("order_key", "key_hash")


@query(f"SELECT DISTINCT {q.PLAIN_HASH} AS key_hash FROM orders")
def update_index(spark, sf_dir):
    added = with_key_hash(order_observations(spark, sf_dir), ORDER_KEYS)
    return delta.update_index(_first_index(spark, sf_dir), added)


# ---- deduplication -----------------------------------------------------------------------

_TOP_EVENT = """QUALIFY row_number() OVER (PARTITION BY internal_series_code, obs_time
    ORDER BY version DESC NULLS LAST, event_id DESC) = 1"""
_TOP_LINE = """QUALIFY row_number() OVER (PARTITION BY internal_series_code, obs_time ORDER BY version DESC
    NULLS LAST, value DESC, order_key DESC, part_key DESC, supp_key DESC) = 1"""


def _line_ties():
    return [F.col(c).desc() for c in ("value", "order_key", "part_key", "supp_key")]


@query(
    f"""WITH {q.OBS_E} SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, value, version,
        event_id FROM obs_e {_TOP_EVENT}"""
)
def dedup_latest_version(spark, sf_dir):
    rows = dedup.latest_wins(
        event_observations(spark, sf_dir), EVENT_KEYS, tie_breakers=[F.col("event_id").desc()]
    )
    return rows.withColumn("obs_time", time_text("obs_time"))


@query(
    f"""WITH {q.OBS_E} SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, value, event_id
    FROM obs_e QUALIFY row_number() OVER (PARTITION BY internal_series_code, obs_time ORDER BY event_id) = 1"""
)
def dedup_keep_first(spark, sf_dir):
    rows = dedup.keep_first(event_observations(spark, sf_dir).drop("version"), EVENT_KEYS, ["event_id"])
    return rows.withColumn("obs_time", time_text("obs_time"))


@query(
    f"""WITH {q.OBS_L} SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, value, version,
        order_key FROM obs_l WHERE year = 1998 AND month = 3 {_TOP_LINE}"""
)
def consolidate_month(spark, sf_dir):
    month = line_observations(spark, sf_dir).where("year = 1998 AND month = 3")
    rows = dedup.consolidate(month, EVENT_KEYS, tie_breakers=_line_ties())
    return rows.withColumn("obs_time", time_text("obs_time")).select(
        "internal_series_code", "obs_time", "value", "version", "order_key"
    )


@query(
    f"""WITH {q.OBS_L} SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, value, version,
        order_key, year, month FROM obs_l {_TOP_LINE}"""
)
def consolidate_all(spark, sf_dir):
    rows = dedup.consolidate(line_observations(spark, sf_dir), EVENT_KEYS, tie_breakers=_line_ties())
    return rows.withColumn("obs_time", time_text("obs_time")).drop("part_key", "supp_key")


@query(
    f"""WITH {q.OBS_E} SELECT internal_series_code, {q.time_text('obs_time')} AS obs_time, value, version,
        event_id FROM obs_e WHERE internal_series_code <> 'error' {_TOP_EVENT}"""
)
def consolidate_skip_no_series(spark, sf_dir):
    """Error events lose their series code, so the read model leaves them out."""
    named = F.when(F.col("internal_series_code") != "error", F.col("internal_series_code"))
    events = event_observations(spark, sf_dir).withColumn("internal_series_code", named)
    rows = dedup.consolidate(events, EVENT_KEYS, tie_breakers=[F.col("event_id").desc()])
    return rows.withColumn("obs_time", time_text("obs_time"))


@query(
    """SELECT event_id AS id, value, event_type AS kind, CAST(NULL AS VARCHAR) AS status FROM events
    UNION ALL SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR), o_orderstatus FROM orders"""
)
def union_versions(spark, sf_dir):
    """Two frames with different columns, aligned by name."""
    events = table(spark, sf_dir, "events").selectExpr("event_id AS id", "value", "event_type AS kind")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus AS status", "o_totalprice AS value", "o_orderkey AS id"
    )
    return dedup.union_versions([events, orders])


# ---- month aggregates --------------------------------------------------------------------


@query(
    f"""WITH {q.OBS_L} SELECT year, month, COUNT(DISTINCT internal_series_code) AS series FROM obs_l
    GROUP BY ALL"""
)
def series_count(spark, sf_dir):
    return (
        line_observations(spark, sf_dir)
        .groupBy("year", "month")
        .agg(F.countDistinct("internal_series_code").alias("series"))
    )


@query(
    f"""WITH {q.OBS_O} SELECT year, month, COUNT(*) AS n, {q.cents('value')} AS total_cents FROM obs_o
    GROUP BY ALL"""
)
def rows_per_month(spark, sf_dir):
    rows = add_year_month(order_observations(spark, sf_dir))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), cents("value").alias("total_cents"))


@query(f"WITH {q.OBS_O} SELECT DISTINCT year, month FROM obs_o ORDER BY year, month")
def affected_months(spark, sf_dir):
    return distinct_months(add_year_month(order_observations(spark, sf_dir)))
