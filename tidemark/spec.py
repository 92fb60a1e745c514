"""Dataset descriptions: what to extract, how rows are keyed, what to stamp on them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tidemark.functions.labels import column_index


@dataclass(frozen=True)
class SeriesSpec:
    """One series: a date column and a value column of a sheet or wide table.

    ``start_data_row`` counts rows after the header row has been consumed; when it
    is missing, ``header_row + 1`` rows are skipped. ``end_row`` uses the same
    counting and is exclusive.
    """

    code: str
    date_col: str
    value_col: str
    sheet: str | None = None
    header_row: int = 0
    start_data_row: int | None = None
    end_row: int | None = None
    drop_na: bool = True
    unit: str | None = None
    frequency: str | None = None

    def __post_init__(self) -> None:
        if not self.code:
            raise ValueError("a series needs a code")
        _require_columns(self.code, date_col=self.date_col, value_col=self.value_col)

    @property
    def first_offset(self) -> int:
        return self.header_row + 1 if self.start_data_row is None else self.start_data_row


@dataclass(frozen=True)
class CategorySpec:
    """Many series in one date/value column pair, told apart by a label column."""

    prefix: str
    category_col: str
    date_col: str
    value_col: str
    mapping: Mapping[str, str]
    skip_headers: tuple[str, ...] = ()
    sheet: str | None = None
    header_row: int = 0
    start_data_row: int | None = None
    end_row: int | None = None
    drop_na: bool = True
    unit: str | None = None
    frequency: str | None = None

    def __post_init__(self) -> None:
        if self.mapping and not self.category_col:
            raise ValueError(f"{self.prefix}: a category mapping needs category_col")
        _require_columns(self.prefix, date_col=self.date_col, value_col=self.value_col)

    @property
    def first_offset(self) -> int:
        return self.header_row + 1 if self.start_data_row is None else self.start_data_row


@dataclass(frozen=True)
class DatasetSpec:
    """Contract of one dataset."""

    dataset_id: str
    primary_keys: tuple[str, ...]
    frequency: str = ""
    timezone: str | None = None
    provider: str | None = None
    unit: str | None = None
    source_kind: str = "http"
    source_format: str | None = "xlsx"
    extractor: str | None = "long"
    normalizer: str | None = "generic"
    plugin: str | None = None
    series: tuple[SeriesSpec | CategorySpec, ...] = ()
    time_formats: tuple[str, ...] = ()
    on_bad_local_time: str = "raise"
    escape_separator: bool = False
    # Days after the run time up to which a row can lie; a later one fails the run, because
    # it would make every following row look old. None allows any time.
    horizon_days: int | None = 3660
    options: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.dataset_id:
            raise ValueError("dataset_id is required")
        if not self.primary_keys:
            raise ValueError(f"{self.dataset_id}: at least one primary key is required")
        if self.source_format not in (None, "csv", "xlsx"):
            raise ValueError(f"{self.dataset_id}: unknown source format {self.source_format!r}")
        if self.source_kind not in ("http", "local"):
            raise ValueError(f"{self.dataset_id}: unknown source kind {self.source_kind!r}")

    @property
    def stamped_source_kind(self) -> str:
        """FILE for anything with a file format, API for a format-less http source."""
        if self.source_format is None and self.source_kind == "http":
            return "API"
        return "FILE"


def _require_columns(owner: str, **columns: str) -> None:
    for name, value in columns.items():
        if not value:
            raise ValueError(f"{owner}: {name} is required")


def column_position(reference: str) -> int:
    """Zero-based position of a column letter used in a spec."""
    return column_index(reference)
