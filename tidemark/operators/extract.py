"""Wide grids to long observations, one pass over the input however many series there are.

Three input shapes share one plan, ``explode`` of an array with one struct per series:

* a wide table, its columns addressed by letter or name,
* sheet rows ``(path, sheet, row_idx, cells ARRAY)``, as the workbook source gives them,
* cells ``(path, sheet, row_idx, col_idx, value)``, first folded back into rows.

The series list is configuration (tens of entries), so it becomes literals of the plan
instead of a join, and nothing is shuffled except to fold loose cells into rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import OBSERVATION, SERIES
from tidemark.sources.local import local_rows, no_rows
from tidemark.spec import CategorySpec, SeriesSpec, column_position

_LABEL_CODES = T.StructType(
    [
        T.StructField("_spec", T.IntegerType()),
        T.StructField("_label", T.StringType()),
        T.StructField("_code", T.StringType()),
    ]
)

Spec = SeriesSpec | CategorySpec


def extract_wide(
    df: DataFrame,
    series: Sequence[SeriesSpec],
    row_idx: str | None = None,
    by: str = "position",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Unpivot the (date, value) column pairs of a wide table.

    ``row_idx`` names the column that numbers rows after the header; without it rows
    have no order and a spec must not ask for skipped ones. ``keep`` carries columns along.
    """
    return _extract(
        df,
        series,
        cell=lambda ref: F.col(_column_name(df, ref, by)),
        cell_type=lambda ref: df.schema[_column_name(df, ref, by)].dataType,
        in_scope=lambda spec: _row_window(spec, row_idx),
        keep=keep,
    )


def extract_category(
    df: DataFrame,
    specs: Sequence[CategorySpec],
    row_idx: str | None = None,
    by: str = "position",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows whose label is mapped, coded ``prefix_suffix``; other labels vanish."""
    return _extract(
        df,
        specs,
        cell=lambda ref: F.col(_column_name(df, ref, by)),
        cell_type=lambda ref: df.schema[_column_name(df, ref, by)].dataType,
        in_scope=lambda spec: _row_window(spec, row_idx),
        keep=keep,
    )


def extract_rows(rows: DataFrame, specs: Sequence[Spec], keep: Sequence[str] = ()) -> DataFrame:
    """Observations of every workbook in a table of sheet rows."""

    def in_scope(spec: Spec) -> Column:
        # Row 0 is the first row of the sheet; data begins below the header row.
        first = spec.header_row + 1 + spec.first_offset
        scope = F.col("row_idx") >= first
        if spec.end_row is not None:
            scope &= F.col("row_idx") < spec.header_row + 1 + spec.end_row
        return scope & (F.col("sheet") == spec.sheet) if spec.sheet is not None else scope

    return _extract(
        rows,
        specs,
        cell=lambda ref: F.get(F.col("cells"), F.lit(column_position(ref))),
        cell_type=lambda ref: T.StringType(),
        in_scope=in_scope,
        keep=keep,
    )


def extract_cells(cells: DataFrame, specs: Sequence[Spec], keep: Sequence[str] = ()) -> DataFrame:
    """Observations of a table of loose cells."""
    return extract_rows(rows_of_cells(cells, specs), specs, keep)


def rows_of_cells(cells: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """Fold cells into sheet rows, keeping only the columns some series reads.

    Unused sheets and columns are filtered before the one shuffle, and the fold has a
    map-side half, so a sheet stored in row order shrinks before it moves.
    """
    wanted = sorted({column_position(ref) for spec in specs for ref in _references(spec)})
    sheets = {spec.sheet for spec in specs}
    used = cells.where(F.col("col_idx").isin(wanted)) if wanted else cells.limit(0)
    if None not in sheets:
        used = used.where(F.col("sheet").isin(sorted(sheets)))
    folded = used.groupBy("path", "sheet", "row_idx").agg(
        *[F.max(F.when(F.col("col_idx") == p, F.col("value"))).alias(f"_{p}") for p in wanted]
    )
    width = wanted[-1] + 1 if wanted else 0
    by_position = [
        F.col(f"_{p}") if p in wanted else F.lit(None).cast("string") for p in range(width)
    ]
    return folded.select("path", "sheet", "row_idx", F.array(*by_position).alias("cells"))


def drop_missing(df: DataFrame, columns: Sequence[str] = ("obs_time", "value")) -> DataFrame:
    """Drop rows where any of ``columns`` is null or NaN."""
    return df.where(all_present([(F.col(c), df.schema[c].dataType) for c in columns]))


def _extract(
    df: DataFrame,
    specs: Sequence[Spec],
    cell: Callable[[str], Column],
    cell_type: Callable[[str], T.DataType],
    in_scope: Callable[[Spec], Column],
    keep: Sequence[str],
) -> DataFrame:
    if not specs:
        schema = T.StructType([df.schema[c] for c in keep] + OBSERVATION.fields)
        return no_rows(df.sparkSession, schema)

    time_type = _common_type([cell_type(s.date_col) for s in specs])
    value_type = _common_type([cell_type(s.value_col) for s in specs])
    with_unit = any(s.unit is not None for s in specs)
    with_frequency = any(s.frequency is not None for s in specs)
    with_label = any(isinstance(s, CategorySpec) for s in specs)

    entries = []
    for number, spec in enumerate(specs):
        time, value = cell(spec.date_col), cell(spec.value_col)
        wanted = in_scope(spec)
        if spec.drop_na:
            wanted &= all_present(
                [(time, cell_type(spec.date_col)), (value, cell_type(spec.value_col))]
            )
        fields = [time.cast(time_type).alias("obs_time"), value.cast(value_type).alias("value")]
        if isinstance(spec, CategorySpec):
            label = cell(spec.category_col).cast("string")
            wanted &= label.isNotNull()
            if spec.skip_headers:
                wanted &= ~label.isin(list(spec.skip_headers))
            fields += [F.lit(None).cast("string").alias(SERIES), label.alias("_label")]
        else:
            fields += [F.lit(spec.code).alias(SERIES)]
            if with_label:
                fields += [F.lit(None).cast("string").alias("_label")]
        if with_unit:
            fields += [F.lit(spec.unit).cast("string").alias("unit")]
        if with_frequency:
            fields += [F.lit(spec.frequency).cast("string").alias("frequency")]
        if with_label:
            fields += [F.lit(number).alias("_spec")]
        entries.append(F.when(wanted, F.struct(*fields)))

    long = df.select(*keep, F.explode(F.array(*entries)).alias("_obs")).where("_obs IS NOT NULL")
    long = long.select(*keep, "_obs.*")
    return _code_labels(long, specs) if with_label else long


def _code_labels(long: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    mapped = [
        {"_spec": number, "_label": label, "_code": f"{spec.prefix}_{suffix}"}
        for number, spec in enumerate(specs)
        if isinstance(spec, CategorySpec)
        for label, suffix in spec.mapping.items()
    ]
    plain = [n for n, s in enumerate(specs) if isinstance(s, SeriesSpec)]
    # No hint: the mapping is a local relation, so Spark knows its size.
    codes = local_rows(long.sparkSession, mapped, _LABEL_CODES)
    columns = [name for name in long.columns if name not in ("_spec", "_label")]
    labelled = long.drop(SERIES).join(codes, ["_spec", "_label"]).withColumnRenamed("_code", SERIES)
    if not plain:
        return labelled.select(*columns)
    uncoded = long.where(F.col("_spec").isin(plain)).select(*columns)
    return labelled.select(*columns).unionByName(uncoded)


def _references(spec: Spec) -> list[str]:
    references = [spec.date_col, spec.value_col]
    return references + [spec.category_col] if isinstance(spec, CategorySpec) else references


def _column_name(df: DataFrame, reference: str, by: str) -> str:
    if by == "name":
        return reference
    position = column_position(reference)
    if position >= len(df.columns):
        raise ValueError(f"column {reference} is position {position} of {len(df.columns)} columns")
    return df.columns[position]


def _row_window(spec: Spec, row_idx: str | None) -> Column:
    if row_idx is None:
        if spec.first_offset != 0 or spec.end_row is not None:
            raise ValueError("skipping rows needs a row_idx column to count by, or start_data_row=0")
        return F.lit(True)
    window = F.col(row_idx) >= spec.first_offset
    return window & (F.col(row_idx) < spec.end_row) if spec.end_row is not None else window


def _common_type(types: list[T.DataType]) -> T.DataType:
    if all(t == types[0] for t in types):
        return types[0]
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    return T.StringType()


def all_present(columns: list[tuple[Column, T.DataType]]) -> Column:
    present = F.lit(True)
    for column, data_type in columns:
        present &= column.isNotNull()
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            present &= ~F.isnan(column)
    return present
