"""The tables of one dataset, under one root directory.

    events/version=V/year=Y/month=MM/          immutable rows added by version V
    events_undated/version=V/                  the same for frames without a date column
    key_index/generation=G/version=V/year=Y/month=MM/   key hashes added by version V
    index_generations/                         which generation is current
    staging/version=V/                         rows of a batch while their keys are looked up
    source_files/version=V/                    hash of every source file V was made from
    file_reads/version=V/                      when and how each of these files was last read
    series_marks/version=V/                    latest time per series as of V, if asked for
    manifest_files/V/manifest.json             the manifest of version V for other tools
    manifests/after-U.parquet                  the version that follows U; naming it so is the commit
    projections/year=Y/month=MM/               latest row per key, rebuilt per month
    month_status/                              log of month rebuilds

Every reader of events and index keeps only versions that have a manifest row, so what a
failed run leaves behind is never seen. The driver compares version labels, one per run,
with directory names, and the scan gets a plain partition filter: no join over the rows.
Labels only grow. The file of a manifest is named after the version before it and renamed to
that name only if it is free, so of several writers one follows each version.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.functions.labels import MANIFEST_FOLDER, POINTER_SUFFIX, two_digits
from tidemark.operators.delta import prune_index, rebuild_index
from tidemark.operators.normalize import add_year_month
from tidemark.sources.local import local_rows, no_rows
from tidemark.sources.paths import (
    child_names,
    child_sizes,
    has_entries,
    move_if_absent,
    path_exists,
    remove_path,
    write_text,
)
from tidemark.sources.tabular import read_table

_LABEL = re.compile(r"^[0-9A-Za-z._-]+$")

IN_PROGRESS = "in_progress"
COMPLETED = "completed"
# Published rows, of which none names its series: there is nothing to project.
EMPTY = "empty"
FAILED = "failed"

# A month of the read model with this many files below this size is written anew, if they hold
# enough of it.
MANY_FILES = 16
SMALL_FILE = 1 << 25

# The last time that Python can hold.
_LAST_TIME = "9999-12-31 23:59:59.999999"

Month = tuple[int, int]


@dataclass(frozen=True)
class VersionStats:
    """What one version added; one entry per calendar month it touches."""

    rows: int
    months: tuple[Row, ...]
    # Rows after the latest time allowed.
    late_rows: int = 0

    @property
    def min_obs_time(self) -> datetime | None:
        return min((m.min_obs_time for m in self.months if m.min_obs_time), default=None)

    @property
    def max_obs_time(self) -> datetime | None:
        return max((m.max_obs_time for m in self.months if m.max_obs_time), default=None)

    @property
    def month_list(self) -> list[Month]:
        return sorted((m.year, m.month) for m in self.months if m.year is not None)


class SeriesStore:
    def __init__(self, spark: SparkSession, root: str, dataset_id: str):
        self.spark = spark
        self.dataset_id = dataset_id
        self.base = f"{root.rstrip('/')}/{dataset_id}"
        self._seen: tuple[frozenset[str], list[str], Row | None] | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.base, *parts])

    # ---- manifests -------------------------------------------------------------------

    def manifests(self) -> DataFrame:
        return read_table(self.spark, self.path("manifests"), S.MANIFEST)

    def versions(self) -> list[str]:
        """Committed version labels, oldest first; one short text per run."""
        return self._manifest_state()[0]

    def current_manifest(self) -> Row | None:
        return self._manifest_state()[1]

    def _manifest_state(self) -> tuple[list[str], Row | None]:
        """All labels and the newest manifest, read again only when a manifest file is new.

        Manifests are only ever added, so an unchanged listing means unchanged rows.
        """
        files = frozenset(child_names(self.spark, self.path("manifests")))
        if self._seen is None or self._seen[0] != files:
            labels, newest = [], None
            if files:
                rows = self.manifests()
                labels, newest = rows.agg(
                    F.sort_array(F.collect_set("version")),
                    F.max_by(F.struct(*rows.columns), "version"),
                ).first()
            self._seen = (files, labels, newest)
        return self._seen[1], self._seen[2]

    def current_version(self) -> str | None:
        manifest = self.current_manifest()
        return manifest.version if manifest else None

    def pointer(self) -> DataFrame:
        """``(dataset_id, current_version)``; no row before the first version."""
        return (
            self.manifests()
            .groupBy("dataset_id")
            .agg(F.max("version").alias("current_version"))
        )

    def months_of(self, manifests: DataFrame | None = None) -> DataFrame:
        """``(version, year, month, rows, min_obs_time, max_obs_time)`` from the manifests.

        What each version touched is read here, never by scanning events.
        """
        manifests = self.manifests() if manifests is None else manifests
        return manifests.select("version", F.inline("outputs.months"))

    def batch_versions(self, stream: str, number: int) -> list[str]:
        """Versions made from one micro-batch; at most one."""
        same = (F.col("batch.stream") == stream) & (F.col("batch.number") == number)
        return [r.version for r in self.manifests().where(same).select("version").collect()]

    def versions_in(self, months: Sequence[Month]) -> list[tuple[str, Month]]:
        """``(version, month)`` of the committed versions that have rows in these months,
        from the manifests."""
        rows = self.months_of().where(in_months(months)).select("version", "year", "month")
        return sorted({(r.version, (r.year, r.month)) for r in rows.collect()})

    def append_manifest(
        self,
        version: str,
        stats: VersionStats,
        rows_total: int,
        event_schema: T.StructType,
        key_columns: Sequence[str],
        source: Row | None,
        created_at: datetime,
        batch: tuple[str, int] | None = None,
        after: str | None = None,
        zone: str | None = None,
        escape_separator: bool = False,
    ) -> bool:
        """Commit ``version`` as what follows ``after`` (None: nothing); False if another
        version does already."""
        row = {
            "dataset_id": self.dataset_id,
            "version": version,
            "created_at": created_at,
            "batch": {"stream": batch[0], "number": batch[1]} if batch else None,
            "source": source.asDict() if source else None,
            "outputs": {
                "data_prefix": self.path("events", f"version={version}"),
                "months": [m.asDict() for m in stats.months],
                "rows_total": rows_total,
                "rows_added_this_version": stats.rows,
                "min_obs_time": stats.min_obs_time,
                "max_obs_time": stats.max_obs_time,
                "event_schema": event_schema.json(),
                "table_schema": self._merged_schema(event_schema).json(),
            },
            "index": {
                "path": self.path("key_index"),
                "key_columns": list(key_columns),
                "hash_column": S.KEY_HASH,
                "zone": zone,
                "escaped": escape_separator,
            },
        }
        self._write_manifest_json(row)
        labels, _ = self._manifest_state()
        if not self._commit(row, after):
            return False
        files = frozenset(child_names(self.spark, self.path("manifests")))
        if len(files - self._seen[0]) == 1:
            # What was just written, and nothing else, is new: it need not be read again.
            self._seen = (files, [*labels, version], _as_row(row, S.MANIFEST))
        return True

    def _commit(self, row: dict, after: str | None) -> bool:
        folder = self.path("staging", f"manifest={uuid.uuid4().hex}")
        local_rows(self.spark, [row], S.MANIFEST).coalesce(1).write.parquet(folder)
        try:
            [part] = [name for name in child_names(self.spark, folder) if name.endswith(".parquet")]
            name = f"after-{after}.parquet" if after else "first.parquet"
            return move_if_absent(self.spark, f"{folder}/{part}", self.path("manifests", name))
        finally:
            remove_path(self.spark, folder)

    def _write_manifest_json(self, row: dict) -> None:
        """The same for other tools, before the commit, so that no notice leads nowhere."""
        outputs = row["outputs"]
        folders = [
            f"{outputs['data_prefix']}/year={m['year']}/month={m['month']:02d}"
            for m in outputs["months"]
            if m["year"] is not None
        ]
        counts = {k: outputs[k] for k in ("data_prefix", "rows_total", "rows_added_this_version")}
        document = {
            "dataset_id": row["dataset_id"],
            "version": row["version"],
            "created_at": row["created_at"].isoformat(),
            "outputs": {**counts, "files": sorted(folders)},
            "index": {k: row["index"][k] for k in ("path", "key_columns", "hash_column")},
        }
        target = self.path(MANIFEST_FOLDER, row["version"], POINTER_SUFFIX)
        write_text(self.spark, target, json.dumps(document, sort_keys=True))

    # ---- events ----------------------------------------------------------------------

    def write_events(self, version: str, delta: DataFrame) -> None:
        """Write the rows of one version, by month if they have a date column.

        The rebalance brings a month together and lets AQE cut a month that holds much
        of the delta into several files, so no task and no file grows with one month.
        Rows inside a file lie by series and time, for row-group skipping.
        """
        self._discard_events(version)
        date_column = S.find_date_column(delta.columns)
        if date_column is None:
            delta.drop("version").write.mode("errorifexists").parquet(
                self.path("events_undated", f"version={version}")
            )
            return
        body = add_year_month(delta.drop("version"), date_column)
        _by_month(body, [c for c in (S.SERIES, date_column) if c in body.columns]).write.mode(
            "errorifexists"
        ).partitionBy("year", "month").parquet(self.path("events", f"version={version}"))

    def read_written(self, version: str, body: T.StructType) -> DataFrame:
        """Rows of one version whether or not it is committed; ``body`` as it was written."""
        return self._read_events(version, body)

    def stats_of(self, version: str, body: T.StructType, latest: datetime | None = None) -> VersionStats:
        """Counts and time range per month of a written version; reads one column. Times that
        Python has no date for do not reach it: they count as the last that it has."""
        written = self._read_events(version, body)
        date_column = S.find_date_column(body.names)
        time = F.col(date_column).cast("timestamp_ntz") if date_column else F.lit(None).cast("timestamp_ntz")
        months = (
            written.select("year", "month", time.alias("t"))
            .withColumn("late", F.col("t") > F.lit(latest).cast("timestamp_ntz") if latest else F.lit(False))
            .withColumn("t", F.least("t", F.lit(_LAST_TIME).cast("timestamp_ntz")))
            .groupBy("year", "month")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.min("t").alias("min_obs_time"),
                F.max("t").alias("max_obs_time"),
                F.count_if("late").alias("late"),
            )
            .collect()
        )
        stats = tuple(Row(**{k: v for k, v in m.asDict().items() if k != "late"}) for m in months)
        return VersionStats(sum(m["rows"] for m in months), stats, sum(m["late"] for m in months))

    def event_schema(self) -> T.StructType:
        """Columns of all committed versions together, as the current manifest records them."""
        manifest = self.current_manifest()
        if manifest is None:
            return S.ENRICHED_EVENT
        return T.StructType.fromJson(json.loads(manifest.outputs.table_schema))

    def _merged_schema(self, added: T.StructType) -> T.StructType:
        current = self.current_manifest()
        before = [T.StructType.fromJson(json.loads(current.outputs.table_schema))] if current else []
        merged = S.merge_schemas([*before, added])
        fixed = [f for f in S.ENRICHED_EVENT.fields if f.name in merged.names]
        return T.StructType(fixed + [f for f in merged.fields if f.name not in S.ENRICHED_EVENT.names])

    def events(self, skip_unreadable: bool = False) -> DataFrame:
        """All rows of committed versions, with ``version``, ``year`` and ``month``.

        Filters on those three are partition filters.
        """
        body = self.event_schema()
        full = _with_partitions(body)
        target = self.path("events")
        rows = read_table(self.spark, target, full, skip_unreadable)
        return rows.where(self._is_committed(target)).select(*full.names)

    def events_in(
        self,
        months: Sequence[Month],
        skip_unreadable: bool = False,
        after: Mapping[Month, str] | None = None,
    ) -> DataFrame:
        """All committed rows of some months. Only the directories that the manifests name
        are listed and read, however many versions there are; of a month in ``after`` only
        those of later versions."""
        body = self.event_schema()
        full, table = _with_partitions(body), self.path("events")
        paths = [
            f"{table}/version={version}/year={year}/month={month:02d}"
            for version, (year, month) in self.versions_in(months)
            if version > (after or {}).get((year, month), "")
        ]
        if not paths:
            return no_rows(self.spark, full)
        reader = self.spark.read.schema(full).option("basePath", table)
        if skip_unreadable:
            reader = reader.option("ignoreCorruptFiles", True)
        return reader.parquet(*paths).select(*full.names)

    def events_of(self, version: str) -> DataFrame:
        """Rows one committed version added; reads that version's directory alone."""
        manifest = self.manifests().where(F.col("version") == version)
        rows = manifest.select("outputs.event_schema").collect()
        if not rows:
            return no_rows(self.spark, _with_partitions(self.event_schema()))
        return self._read_events(version, T.StructType.fromJson(json.loads(rows[0][0])))

    def undated_events(self) -> DataFrame:
        body = self.event_schema()
        full = T.StructType([f for f in body.fields if f.name != "version"]).add("version", "string")
        target = self.path("events_undated")
        return read_table(self.spark, target, full).where(self._is_committed(target))

    def _read_events(self, version: str, body: T.StructType) -> DataFrame:
        undated = S.find_date_column(body.names) is None
        table = self.path("events_undated" if undated else "events")
        full = _with_partitions(body)
        target = f"{table}/version={version}"
        if not has_entries(self.spark, target):
            return no_rows(self.spark, full)
        read = T.StructType([f for f in full.fields if not (undated and f.name in ("year", "month"))])
        rows = self.spark.read.schema(read).option("basePath", table).parquet(target)
        if undated:
            rows = rows.withColumns({c: F.lit(None).cast("int") for c in ("year", "month")})
        return rows.select(*full.names)

    def series_marks(self) -> DataFrame:
        """Latest observation time of each series, ``(series, max_obs_time)``.

        Kept as a small table per version that asked for it: the one before it and the
        events published since are reduced to the next, so no history is read again.
        """
        current = self.current_version()
        if current is None:
            return no_rows(self.spark, S.SERIES_MARK)
        base = self.path("series_marks")
        known = {name.removeprefix("version=") for name in child_names(self.spark, base)}
        built = known.intersection(self.versions())
        before = max((v for v in built if has_entries(self.spark, f"{base}/version={v}")), default=None)
        if before != current:
            fresh = self.events_since(before).select(*S.SERIES_MARK.names[:1], F.col("obs_time").alias("max_obs_time"))
            if before is not None:
                fresh = fresh.union(self._marks_of(before))
            marks = fresh.groupBy(S.SERIES).agg(F.max("max_obs_time").alias("max_obs_time"))
            marks.write.mode("overwrite").parquet(f"{base}/version={current}")
        return self._marks_of(current)

    def _marks_of(self, version: str) -> DataFrame:
        return self.spark.read.schema(S.SERIES_MARK).parquet(self.path("series_marks", f"version={version}"))

    def events_since(self, version: str | None) -> DataFrame:
        """Rows of the committed versions later than one; only their directories are listed."""
        full, table = _with_partitions(self.event_schema()), self.path("events")
        later = [v for v in self.versions() if version is None or v > version]
        paths = [p for p in (f"{table}/version={v}" for v in later) if path_exists(self.spark, p)]
        if not paths:
            return no_rows(self.spark, full)
        return self.spark.read.schema(full).option("basePath", table).parquet(*paths).select(*full.names)

    def stage(self, version: str, rows: DataFrame) -> DataFrame:
        """The rows of a batch as a table of their own until the version is published."""
        target = self.path("staging", f"version={version}")
        rows.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target)

    def unstage(self, version: str) -> None:
        remove_path(self.spark, self.path("staging", f"version={version}"))

    # ---- key index -------------------------------------------------------------------

    def _generation(self) -> Row | None:
        if not path_exists(self.spark, self.path("index_generations")):
            return None
        table = read_table(self.spark, self.path("index_generations"), S.INDEX_GENERATION)
        return table.agg(F.max_by(F.struct(*table.columns), "generation")).first()[0]

    def index_generation(self) -> int:
        newest = self._generation()
        return newest.generation if newest else 0

    def rows_total(self) -> int:
        """Distinct keys published so far: what the newest manifest says, or the rebuild of
        the index if that was later."""
        manifest, newest = self.current_manifest(), self._generation()
        if manifest is None:
            return 0
        rebuilt = newest is not None and newest.built_at_version == manifest.version
        return newest.rows_total if rebuilt and newest.rows_total is not None else manifest.outputs.rows_total

    def index(
        self, since: datetime | None = None, months: Sequence[Month] | None = None
    ) -> DataFrame:
        """Hashes of committed versions; with ``since`` only of that month and later, with
        ``months`` only of those."""
        target = self.path("key_index", f"generation={self.index_generation()}")
        rows = read_table(self.spark, target, S.KEY_INDEX).where(self._is_committed(target))
        if months is not None:
            rows = rows.where(in_months(months))
        return prune_index(rows, since)

    def write_index(
        self,
        version: str,
        events: DataFrame,
        keys: Sequence[str],
        zone: str | None,
        escape_separator: bool,
        known: DataFrame | None,
        generation: int | None = None,
    ) -> int:
        """Store the hashes of ``events`` that are not in ``known``; returns how many."""
        generation = self.index_generation() if generation is None else generation
        target = self.path("key_index", f"generation={generation}", f"version={version}")
        remove_path(self.spark, target)
        hashes = rebuild_index(events, keys, zone, escape_separator, months=True)
        if known is not None:
            hashes = hashes.join(known.select(S.KEY_HASH), S.KEY_HASH, "left_anti")
        if "obs_time" not in keys:
            # The month of a key that has no time says nothing; keep one row per key.
            hashes = hashes.select(S.KEY_HASH).distinct().withColumns(
                {c: F.lit(None).cast("int") for c in ("year", "month")}
            )
        # Hashes hardly repeat, so a dictionary of them would be built in vain.
        _by_month(hashes, [S.KEY_HASH]).write.mode("errorifexists").option(
            "parquet.enable.dictionary", False
        ).partitionBy("year", "month").parquet(target)
        written = T.StructType([f for f in S.KEY_INDEX.fields if f.name != "version"])
        if not has_entries(self.spark, target):
            return 0
        return self.spark.read.schema(written).parquet(target).count()

    def index_rows(self, versions: Sequence[str]) -> dict[tuple[str, Month], int]:
        """Keys that some versions added to each month, from the footers of their index files."""
        keys = self.index().where(F.col("version").isin(list(versions)) & F.col("month").isNotNull())
        counts = keys.groupBy("version", "year", "month").agg(F.count(F.lit(1)).alias("n"))
        return {(r.version, (r.year, r.month)): r.n for r in counts.collect()}

    def hashed_alike(self, keys: Sequence[str]) -> bool:
        """Whether all versions and the index in use have ``keys`` as their key, spelled alike, and
        no key of the index is missing."""
        spelled = self.manifests().select("index.key_columns", "index.zone", "index.escaped").distinct().limit(2).collect()
        if len(spelled) != 1 or spelled[0].key_columns != list(keys) or spelled[0].escaped is None:
            return False
        rebuilt = self._generation()
        if rebuilt is not None and (rebuilt.zone, rebuilt.escaped) != (spelled[0].zone, spelled[0].escaped):
            return False
        return self.index().count() == self.rows_total()

    def append_generation(
        self,
        generation: int,
        version: str,
        rows_total: int,
        zone: str | None = None,
        escape_separator: bool = False,
    ) -> None:
        row = {
            "generation": generation,
            "built_at_version": version,
            "rows_total": rows_total,
            "zone": zone,
            "escaped": escape_separator,
            "stamp": _now(),
        }
        self._append("index_generations", [row], S.INDEX_GENERATION)

    # ---- source files ----------------------------------------------------------------

    def write_source_files(self, version: str, fingerprints: DataFrame) -> None:
        target = self.path("source_files", f"version={version}")
        fingerprints.select(*S.SOURCE_FILE.names).write.mode("overwrite").parquet(target)

    def source_files(self, version: str | None) -> DataFrame:
        if version is None:
            return no_rows(self.spark, S.SOURCE_FILE)
        return read_table(self.spark, self.path("source_files", f"version={version}"), S.SOURCE_FILE)

    def write_file_reads(self, version: str, reads: DataFrame) -> None:
        target = self.path("file_reads", f"version={version}")
        reads.select(*S.FILE_READ.names).write.mode("overwrite").parquet(target)

    def file_reads(self, version: str | None) -> DataFrame:
        if version is None:
            return no_rows(self.spark, S.FILE_READ)
        return read_table(self.spark, self.path("file_reads", f"version={version}"), S.FILE_READ)

    # ---- projections -----------------------------------------------------------------

    def write_projections(self, rows: DataFrame, append: bool = False, in_place: bool = False) -> None:
        """Replace the months present in ``rows``, or ``append`` to them; other months stay.

        Spark stages the new files and moves whole partitions at job commit. ``in_place`` rows
        come month by month from few files, and are written by the tasks that read them.
        """
        order = [c for c in (S.SERIES, "obs_time") if c in rows.columns]
        body = _sorted_by_month(rows, order) if in_place else _by_month(rows, order)
        body.write.mode("append" if append else "overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("year", "month").parquet(self.path("projections"))

    def is_crowded(self, month: Month) -> bool:
        """Whether small files hold much of a month's read model. They have to hold a quarter as
        much as the others, so that writing it anew costs a fixed share of what was appended."""
        sizes = child_sizes(self.spark, self._projection(month))
        small = [s for s in sizes if s < SMALL_FILE]
        return len(small) >= MANY_FILES and 4 * sum(small) >= sum(sizes) - sum(small)

    def projections(self) -> DataFrame:
        full = _with_partitions(self.event_schema())
        return read_table(self.spark, self.path("projections"), full).select(*full.names)

    def has_projection(self, month: Month) -> bool:
        return has_entries(self.spark, self._projection(month))

    def _projection(self, month: Month) -> str:
        return self.path("projections", f"year={month[0]}", f"month={month[1]:02d}")

    # ---- month status ----------------------------------------------------------------

    def append_month_status(
        self,
        months: Sequence[Month],
        status: str,
        version: str | None = None,
        stamp: datetime | None = None,
        reason: str | None = None,
    ) -> None:
        if months:
            common = {
                "dataset_id": self.dataset_id,
                "status": status,
                "version": version,
                "reason": reason,
                "stamp": stamp or _now(),
            }
            rows = [{**common, "year": year, "month": month} for year, month in months]
            self._append("month_status", rows, S.MONTH_STATUS)

    def month_status_log(self) -> DataFrame:
        return read_table(self.spark, self.path("month_status"), S.MONTH_STATUS)

    def due_months(self) -> list[Month]:
        """Months with a committed version later than the one their read model was last
        completed from: those of an interrupted run, and those never built."""
        none = F.lit(None).cast("string")
        published = self.months_of().where("year IS NOT NULL")
        built = self.month_status_log().where(F.col("status").isin(COMPLETED, EMPTY))
        due = (
            published.select("year", "month", F.col("version").alias("published"), none.alias("built"))
            .union(built.select("year", "month", none, "version"))
            .groupBy("year", "month")
            .agg(F.max("published").alias("published"), F.max("built").alias("built"))
            .where("published IS NOT NULL AND (built IS NULL OR built < published)")
        )
        return sorted((r.year, r.month) for r in due.select("year", "month").collect())

    def built_versions(self, months: Sequence[Month]) -> dict[Month, str]:
        """The version that the stored read model of each month has seen; a month whose read
        model is not there, though it had rows to show, is left out."""
        log = self.month_status_log().where(F.col("status").isin(COMPLETED, EMPTY) & in_months(months))
        last = log.groupBy("year", "month").agg(F.max(F.struct("version", "status")).alias("last"))
        return {
            (r.year, r.month): r["last"].version
            for r in last.collect()
            if r["last"].version and (r["last"].status == EMPTY or self.has_projection((r.year, r.month)))
        }

    def interrupted_months(self, months: Sequence[Month]) -> set[Month]:
        """Months whose last rebuild began for a version and did not complete."""
        done = F.when(F.col("status").isin(COMPLETED, EMPTY), F.col("version"))
        log = self.month_status_log().where(in_months(months)).groupBy("year", "month")
        last = log.agg(F.max("version").alias("begun"), F.max(done).alias("done"))
        open_ones = last.where("begun IS NOT NULL AND (done IS NULL OR done < begun)")
        return {(r.year, r.month) for r in open_ones.collect()}

    # ---- shared ----------------------------------------------------------------------

    def discard(self, version: str) -> None:
        """Remove what an uncommitted version wrote."""
        self._discard_events(version)
        generation = self.index_generation()
        remove_path(self.spark, self.path("key_index", f"generation={generation}", f"version={version}"))
        remove_path(self.spark, self.path("source_files", f"version={version}"))
        remove_path(self.spark, self.path("file_reads", f"version={version}"))
        remove_path(self.spark, self.path(MANIFEST_FOLDER, version))
        self.unstage(version)

    def _discard_events(self, version: str) -> None:
        check_label(version)
        for table in ("events", "events_undated"):
            target = self.path(table, f"version={version}")
            if path_exists(self.spark, target):
                if version in self.versions():
                    raise ValueError(f"version {version} is already published")
                remove_path(self.spark, target)

    def _is_committed(self, target: str) -> Column:
        """Partition filter for the versions under ``target`` that have a manifest row.

        A version being written meanwhile is later than the current one, so the upper
        bound hides it; what failed runs left below that bound is excluded by name.
        """
        committed = self.versions()
        if not committed:
            return F.lit(False)
        found = {name.removeprefix("version=") for name in child_names(self.spark, target)}
        leftovers = sorted(v for v in found.difference(committed) if v < committed[-1])
        seen = F.col("version") <= committed[-1]
        return seen & ~F.col("version").isin(leftovers) if leftovers else seen

    def _append(self, table: str, rows: list[dict], schema: T.StructType) -> None:
        local_rows(self.spark, rows, schema).coalesce(1).write.mode("append").parquet(self.path(table))


def _as_row(value: object, data_type: T.DataType) -> object:
    """A nested mapping as the row that reading it back would give."""
    if value is None:
        return None
    if isinstance(data_type, T.StructType):
        return Row(**{f.name: _as_row(value.get(f.name), f.dataType) for f in data_type.fields})
    if isinstance(data_type, T.ArrayType):
        return [_as_row(v, data_type.elementType) for v in value]
    return value


def in_months(months: Sequence[Month]) -> Column:
    """Predicate on the partition columns for a list of months."""
    numbers = [year * 100 + month for year, month in months]
    return (F.col("year") * 100 + F.col("month")).isin(numbers)


def check_label(version: str) -> None:
    """A version label becomes a directory name, so it may hold no path characters."""
    if not _LABEL.match(version):
        raise ValueError(f"not a version label: {version!r}")


def latest_month_status(log: DataFrame) -> DataFrame:
    """Last status of each month; of two with one time stamp, ``completed`` counts."""
    order = F.struct("stamp", F.col("status") == COMPLETED)
    return log.groupBy("dataset_id", "year", "month").agg(F.max_by("status", order).alias("status"))


def _by_month(rows: DataFrame, order: list[str]) -> DataFrame:
    return _sorted_by_month(rows.hint("rebalance", "year", "month"), order)


def _sorted_by_month(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.withColumn("month", two_digits(F.col("month"))).sortWithinPartitions("year", "month", *order)


def _with_partitions(body: T.StructType) -> T.StructType:
    fields = [f for f in body.fields if f.name not in ("year", "month")]
    if "version" not in body.names:
        fields.append(T.StructField("version", T.StringType()))
    return T.StructType(fields + S.MONTH_PARTITION.fields)


def _now() -> datetime:
    return datetime.fromtimestamp(time.time(), timezone.utc)
