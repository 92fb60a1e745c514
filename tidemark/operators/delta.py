"""Which rows are new: the key index and the anti-join against it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import with_key_hash
from tidemark.schema import KEY_HASH

# What the bitmap of a batch may take, which is broadcast; how many bits it has for a hash, so
# that few other hashes fall on a set one; and hexadecimal digits it is addressed by at least.
BITMAP_BYTES = 1 << 25
SPARSE = 16
LEAST_DIGITS = 4


def delta(
    df: DataFrame,
    index: DataFrame | None,
    keys: Sequence[str],
    zone: str | None = None,
    escape_separator: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose key hash is not in ``index``, with the hash added.

    Equal keys inside ``df`` all pass. The join side is Spark's choice: a small index is
    broadcast by its measured size, a large one is shuffled, and a hash that holds much
    of the batch is split by AQE (which it can do for the left side of an anti-join).
    """
    return without_known(with_key_hash(df, keys, zone, escape_separator), index)


def without_known(hashed: DataFrame, index: DataFrame | None) -> DataFrame:
    """Rows whose ``key_hash`` is not in ``index``."""
    if index is None:
        return hashed
    return hashed.join(index.select(KEY_HASH), KEY_HASH, "left_anti").select(*hashed.columns)


def relevant_index(index: DataFrame, hashed: DataFrame, most_bytes: int = BITMAP_BYTES) -> DataFrame:
    """Rows of ``index`` that can match a row of ``hashed``, and few others.

    The first digits of the batch's hashes are set in a bitmap, with at least ``SPARSE`` bits
    for each different hash. It is broadcast, so that index rows without their bit are dropped
    where they are read and what is shuffled follows the batch, not the index. The bitmap is
    sized first; one of more than ``most_bytes`` is not made, and the whole index is returned,
    which gives the same rows in the join. ``hashed`` is read twice: hand in stored rows.
    """
    number = hashed.agg(F.approx_count_distinct(KEY_HASH)).first()[0]
    digits = next((d for d in range(LEAST_DIGITS, 16) if 16**d >= SPARSE * number), 16)
    if 16**digits // 8 > most_bytes:
        return index
    # The functions count from 1.
    place = F.conv(F.substring(KEY_HASH, 1, digits), 16, 10).cast("bigint") + 1
    bits = (
        hashed.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        index.withColumn("_bucket", F.bitmap_bucket_number(place))
        .join(F.broadcast(bits), F.col("_bucket") == F.col("bucket"))
        .where((F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))) % 2) == 1)
        .select(*index.columns)
    )


def existing_keys(
    df: DataFrame,
    index: DataFrame,
    keys: Sequence[str],
    zone: str | None = None,
    escape_separator: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose key is already known."""
    hashed = with_key_hash(df, keys, zone, escape_separator)
    return hashed.join(index.select(KEY_HASH), KEY_HASH, "left_semi").select(*hashed.columns)


def update_index(index: DataFrame | None, added: DataFrame) -> DataFrame:
    """Distinct hashes of the index and the added rows."""
    hashes = added.select(KEY_HASH)
    return (hashes if index is None else index.select(KEY_HASH).union(hashes)).distinct()


def rebuild_index(
    events: DataFrame,
    keys: Sequence[str],
    zone: str | None = None,
    escape_separator: bool = False,
    months: bool = False,
) -> DataFrame:
    """Distinct key hashes of all events; with ``months`` also the month each lies in."""
    columns = ["year", "month"] if months else []
    hashed = with_key_hash(events.select(*dict.fromkeys([*keys, *columns])), keys, zone, escape_separator)
    return hashed.select(KEY_HASH, *columns).distinct()


def prune_index(index: DataFrame, since: datetime | None) -> DataFrame:
    """Index rows of the month of ``since`` and later.

    Valid only when ``obs_time`` is part of the key: then a hash can match nothing
    outside its own month, and rows at or before the watermark never reach the join.
    A predicate on partition columns alone, so earlier months are not read.
    """
    if since is None:
        return index
    return index.where(F.col("year") * 100 + F.col("month") >= since.year * 100 + since.month)
