"""Named extractors and normalisers.

An extractor turns ``(spec, raw DataFrame)`` into long rows, a normaliser turns
``(spec, long DataFrame)`` into typed rows. Both stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.operators import extract
from tidemark.operators.normalize import normalize
from tidemark.spec import DatasetSpec

Step = Callable[[DatasetSpec, DataFrame], DataFrame]

_extractors: dict[str, Step] = {}
_normalizers: dict[str, Step] = {}


def register_extractor(name: str, step: Step) -> None:
    """A later registration under the same name replaces the earlier one."""
    _extractors[_named(name, "extractor")] = step


def register_normalizer(name: str, step: Step) -> None:
    _normalizers[_named(name, "normalizer")] = step


def extractor_of(spec: DatasetSpec) -> Step:
    """The dataset-level plugin name goes before the extractor name."""
    return _find(_extractors, spec.plugin or spec.extractor, "extractor")


def normalizer_of(spec: DatasetSpec) -> Step:
    return _find(_normalizers, spec.plugin or spec.normalizer, "normalizer")


def is_generic(spec: DatasetSpec) -> bool:
    """Whether rows are normalised by the library's own normaliser."""
    return normalizer_of(spec) is _generic


def _named(name: str | None, kind: str) -> str:
    if not name:
        raise ValueError(f"a dataset must name its {kind}")
    return name


def _find(steps: dict[str, Step], name: str | None, kind: str) -> Step:
    found = steps.get(_named(name, kind))
    if found is None:
        raise ValueError(f"no {kind} named {name!r}")
    return found


def _row_idx(df: DataFrame) -> str | None:
    return "row_idx" if "row_idx" in df.columns else None


def _keep(spec: DatasetSpec) -> tuple[str, ...]:
    return tuple(spec.options.get("keep", ()))


def _by(spec: DatasetSpec) -> str:
    return str(spec.options.get("by", "position"))


def _generic(spec: DatasetSpec, df: DataFrame) -> DataFrame:
    return normalize(df, spec.timezone, spec.time_formats, spec.on_bad_local_time)


register_extractor("long", lambda spec, df: df)
register_extractor(
    "wide", lambda spec, df: extract.extract_wide(df, spec.series, _row_idx(df), _by(spec), _keep(spec))
)
register_extractor(
    "category",
    lambda spec, df: extract.extract_category(df, spec.series, _row_idx(df), _by(spec), _keep(spec)),
)
register_extractor("sheet_rows", lambda spec, df: extract.extract_rows(df, spec.series, _keep(spec)))
register_extractor("cells", lambda spec, df: extract.extract_cells(df, spec.series, ()))
register_normalizer("generic", _generic)
