"""SQL fragments shared by the counterparts of several queries."""

from __future__ import annotations

from workloads.views import SNAPSHOT_ENDS, VERSIONS


def time_text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def micros_text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def cents(expression: str) -> str:
    return f"CAST(SUM(CAST(round({expression} * 100) AS BIGINT)) AS BIGINT)"


VERSION = (
    f"CASE WHEN o_orderdate < '{SNAPSHOT_ENDS[0]}' THEN '{VERSIONS[0]}' "
    f"WHEN o_orderdate < '{SNAPSHOT_ENDS[1]}' THEN '{VERSIONS[1]}' ELSE '{VERSIONS[2]}' END"
)

OBS_O = f"""obs_o AS (
    SELECT o_orderdate AS obs_time, o_totalprice AS value, o_orderpriority AS internal_series_code,
           o_orderkey AS order_key, {VERSION} AS version,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders)"""

OBS_E = """obs_e AS (
    SELECT date_trunc('day', ts) AS obs_time, value, event_type AS internal_series_code,
           'v' || strftime(ts, '%H') AS version, event_id
    FROM events)"""

OBS_L = """obs_l AS (
    SELECT l_shipdate AS obs_time, l_extendedprice AS value,
           l_returnflag || '_' || l_linestatus AS internal_series_code,
           'v' || l_linenumber AS version, l_orderkey AS order_key, l_partkey AS part_key,
           l_suppkey AS supp_key, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month
    FROM lineitem)"""

DIRTY = """dirty AS (
    SELECT event_id, event_type AS internal_series_code,
           CASE WHEN minute(ts) >= 52 THEN NULL ELSE ts END AS obs_time,
           CASE WHEN minute(ts) < 6 THEN NULL ELSE value END AS value
    FROM events)"""

STORED_HASH = f"sha1({time_text('o_orderdate')} || '-03:00|' || o_orderkey)"
PLAIN_HASH = f"sha1({time_text('o_orderdate')} || '|' || o_orderkey)"

STORED_ROW = (
    f"SELECT order_key, version, internal_series_code, value, {time_text('obs_time')} AS obs_time FROM obs_o"
)


def stored_rows(where: str) -> str:
    return f"WITH {OBS_O} {STORED_ROW} WHERE {where}"
