"""Extraction from wide tables, sheet rows, cells and real workbook files."""

import io
import os

import pytest
from frames import sorted_rows
from pyspark.sql import functions as F

from tidemark import CategorySpec, DatasetSpec, SeriesSpec, SeriesStore, run_ingest
from tidemark.operators import extract
from tidemark.operators.normalize import normalize
from tidemark.sources import workbooks as reader
from tidemark.sources.snapshots import fingerprint_files
from tidemark.sources.workbooks import cells_of_rows, read_workbooks, sheet_rows
from workloads.workbooks import letters, workbook_bytes


@pytest.fixture
def wide(spark):
    rows = [
        (0, "Title", None, None),
        (1, "2024-01-01", 1.0, 10.0),
        (2, "2024-01-02", None, 20.0),
        (3, "2024-01-03", 3.0, float("nan")),
        (4, None, 4.0, 40.0),
    ]
    return spark.createDataFrame(rows, "row_idx int, day string, first double, second double")


def test_one_series_by_letters(wide):
    spec = SeriesSpec("S", "B", "C", start_data_row=1)
    got = extract.extract_wide(wide, [spec], row_idx="row_idx")
    assert got.columns == ["obs_time", "value", "internal_series_code"]
    assert sorted_rows(got) == [("2024-01-01", 1.0, "S"), ("2024-01-03", 3.0, "S")]


def test_many_series_in_one_pass(wide):
    specs = [
        SeriesSpec("A", "B", "C", start_data_row=1, unit="u", frequency="D"),
        SeriesSpec("B", "B", "D", start_data_row=2),
        SeriesSpec("K", "B", "C", start_data_row=1, end_row=3, drop_na=False),
    ]
    got = extract.extract_wide(wide, specs, row_idx="row_idx")
    assert sorted(tuple(map(str, r)) for r in got.collect()) == [
        ("2024-01-01", "1.0", "A", "u", "D"),
        ("2024-01-01", "1.0", "K", "None", "None"),
        ("2024-01-02", "20.0", "B", "None", "None"),
        ("2024-01-02", "None", "K", "None", "None"),
        ("2024-01-03", "3.0", "A", "u", "D"),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Generate") == 1


def test_default_offset_skips_header_row_plus_one(wide):
    assert SeriesSpec("S", "A", "B", header_row=5).first_offset == 6
    got = extract.extract_wide(wide, [SeriesSpec("S", "B", "C", header_row=2)], row_idx="row_idx")
    assert [r.obs_time for r in got.collect()] == ["2024-01-03"]


def test_empty_series_list_gives_the_base_columns(wide):
    got = extract.extract_wide(wide, [])
    assert got.columns == ["obs_time", "value", "internal_series_code"] and got.count() == 0


def test_offsets_need_a_row_number(wide):
    with pytest.raises(ValueError, match="row_idx"):
        extract.extract_wide(wide, [SeriesSpec("S", "B", "C", start_data_row=2)])
    with pytest.raises(ValueError, match="row_idx"):
        extract.extract_wide(wide, [SeriesSpec("S", "B", "C", header_row=2)])
    with pytest.raises(ValueError, match="row_idx"):
        extract.extract_wide(wide, [SeriesSpec("S", "B", "C")])
    assert extract.extract_wide(wide, [SeriesSpec("S", "B", "C", start_data_row=0, drop_na=False)]).count() == 5
    with pytest.raises(ValueError, match="position"):
        extract.extract_wide(wide, [SeriesSpec("S", "B", "Z")], row_idx="row_idx")


@pytest.fixture
def labelled(spark):
    rows = [
        ("Index", None, None),
        ("General", "2024-01-01", 1.0),
        ("Food", "2024-01-01", 2.0),
        ("Other", "2024-01-01", 3.0),
        ("General", "2024-02-01", None),
        (None, "2024-02-01", 5.0),
    ]
    return spark.createDataFrame(rows, "label string, day string, v double")


def test_categories(labelled):
    spec = CategorySpec(
        "P", "A", "B", "C", {"General": "GEN", "Food": "FOOD", "Index": "X"}, ("Index",), unit="pct", start_data_row=0
    )
    got = extract.extract_category(labelled, [spec])
    assert sorted_rows(got.select("internal_series_code", "obs_time", "value", "unit")) == [
        ("P_FOOD", "2024-01-01", 2.0, "pct"),
        ("P_GEN", "2024-01-01", 1.0, "pct"),
    ]


def test_several_category_blocks_and_a_plain_series_together(labelled):
    specs = [
        CategorySpec("P", "A", "B", "C", {"General": "GEN"}, start_data_row=0),
        CategorySpec("Q", "A", "B", "C", {"General": "GEN", "Food": "FOOD"}, drop_na=False, start_data_row=0),
        SeriesSpec("ALL", "B", "C", start_data_row=0),
    ]
    got = extract.extract_category(labelled, specs).groupBy("internal_series_code").count()
    assert dict(tuple(r) for r in got.collect()) == {"P_GEN": 1, "Q_GEN": 2, "Q_FOOD": 1, "ALL": 4}


def test_spec_errors():
    with pytest.raises(ValueError, match="date_col"):
        CategorySpec("P", "A", "", "C", {"x": "y"})
    with pytest.raises(ValueError, match="category_col"):
        CategorySpec("P", "", "A", "C", {"x": "y"})
    with pytest.raises(ValueError, match="value_col"):
        SeriesSpec("S", "A", "")
    with pytest.raises(ValueError, match="primary key"):
        DatasetSpec("d", ())
    with pytest.raises(ValueError, match="format"):
        DatasetSpec("d", ("obs_time",), source_format="ods")


# ---- workbooks ---------------------------------------------------------------------------

DAY = 45292  # 2024-01-01
BOOK = {
    "DATOS | DATA": [
        ["report"],
        ["date", "rate & co", None, "date2", "base"],
        ["units", None, None, None, None],
        [("date", DAY), 1.5, None, ("date", DAY + 1), 7],
        [("date", DAY + 1), "n/a", None, None, None],
        [("date", DAY + 2.5), 2.5, True, ("date", DAY + 3), 9],
    ],
    "Otra": [["x"], ["<y>", 3]],
}


@pytest.fixture
def folder(root):
    for name in ("one", "two"):
        with open(os.path.join(root, f"{name}.xlsx"), "wb") as out:
            out.write(workbook_bytes(BOOK))
    return root


def test_letters_are_the_inverse_of_positions():
    from tidemark.functions.labels import column_index

    assert all(column_index(letters(i)) == i for i in (0, 25, 26, 701, 702, 16383))


def test_sheet_rows_of_workbook_files(spark, folder):
    rows = read_workbooks(spark, folder)
    assert rows.count() == 16
    one = rows.where(F.col("path").endswith("one.xlsx") & (F.col("sheet") == "DATOS | DATA"))
    got = {r.row_idx: r.cells for r in one.collect()}
    assert got[0] == ["report"]
    assert got[1] == ["date", "rate & co", None, "date2", "base"]
    assert got[3] == ["2024-01-01 00:00:00", "1.5", None, "2024-01-02 00:00:00", "7"]
    assert got[5] == ["2024-01-03 12:00:00", "2.5", "True", "2024-01-04 00:00:00", "9"]
    assert read_workbooks(spark, folder, sheets=["Otra"]).select("sheet").distinct().count() == 1


SPECS = [
    SeriesSpec("RATE", "A", "B", sheet="DATOS | DATA", header_row=1, start_data_row=1, unit="pct"),
    SeriesSpec("BASE", "D", "E", sheet="DATOS | DATA", header_row=1, start_data_row=1),
]
EXPECTED = [
    ("BASE", "2024-01-02 00:00:00", 7.0, None),
    ("BASE", "2024-01-04 00:00:00", 9.0, None),
    ("RATE", "2024-01-01 00:00:00", 1.5, "pct"),
    ("RATE", "2024-01-03 12:00:00", 2.5, "pct"),
]


@pytest.mark.parametrize("shape", ["rows", "cells"])
def test_series_of_workbooks(spark, folder, shape):
    rows = read_workbooks(spark, folder)
    long = extract.extract_rows(rows, SPECS) if shape == "rows" else extract.extract_cells(cells_of_rows(rows), SPECS)
    typed = normalize(long, zone="America/Argentina/Buenos_Aires").withColumn("obs_time", F.col("obs_time").cast("string"))
    got = typed.select("internal_series_code", "obs_time", "value", "unit").collect()
    assert sorted(map(tuple, got), key=str) == sorted(EXPECTED * 2, key=str)


def test_stacked_blocks_can_end(spark):
    rows = spark.createDataFrame(
        [("f", "s", i, [f"2024-01-0{i + 1}", str(i)]) for i in range(8)],
        "path string, sheet string, row_idx int, cells array<string>",
    )
    first = SeriesSpec("A", "A", "B", sheet="s", header_row=0, start_data_row=0, end_row=2)
    second = SeriesSpec("B", "A", "B", sheet="s", header_row=4, start_data_row=0)
    got = extract.extract_rows(rows, [first, second])
    assert sorted_rows(got.select("internal_series_code", "value")) == [("A", "1"), ("A", "2"), ("B", "5"), ("B", "6"), ("B", "7")]


def test_days_since_1904_and_missing_styles(spark):
    files = spark.createDataFrame(
        [
            ("a", bytearray(workbook_bytes({"s": [[("date", 1)]]}, date1904=True))),
            ("b", bytearray(workbook_bytes({"s": [[("date", 1)]]}, date_style=False))),
            ("c", None),
        ],
        "path string, content binary",
    )
    assert sorted_rows(sheet_rows(files).select("path", F.col("cells")[0])) == [("a", "1904-01-02 00:00:00"), ("b", "1")]


def test_ingest_of_workbooks_skips_an_unchanged_folder(spark, folder, root):
    spec = DatasetSpec(
        "book", ("obs_time", "internal_series_code"), extractor="sheet_rows", series=tuple(SPECS), frequency="D"
    )
    files = fingerprint_files(spark, folder, "*.xlsx")
    first = run_ingest(spec=spec, spark=spark, raw=read_workbooks(spark, folder), root=root + "/store", sources=files, version="v1")
    assert (first.rows_added, first.rows_total) == (8, 4)
    again = run_ingest(spec=spec, spark=spark, raw=read_workbooks(spark, folder), root=root + "/store", sources=files, version="v2")
    assert again.reason == "source unchanged"
    store = SeriesStore(spark, root + "/store", "book")
    assert store.projections().count() == 4
    units = dict(tuple(r) for r in store.projections().select("internal_series_code", "unit").distinct().collect())
    assert units == {"RATE": "pct", "BASE": None}


def test_the_reader_keeps_every_kind_of_cell():
    """Text runs, phonetic ones apart, cells without a reference, and a style on a blank cell."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = (
        f'<worksheet {main}><sheetData><row><c><v>1</v></c><c s="1"><v>2.5</v></c><c s="1"/></row>'
        '<row r="4"><c r="B4" t="inlineStr"><is><r><t>a &amp; </t></r><rPh><t>no</t></rPh><r><t>b</t></r></is></c>'
        '<c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="s"><v>1</v></c></row></sheetData></worksheet>'
    )
    found = reader._sheet(io.BytesIO(sheet.encode()), ["x", "y"], frozenset([1]), reader.DAY_ZERO)
    assert list(found) == [(0, ["1", "1900-01-01 12:00:00", None]), (3, [None, "a & b", "True", None, "y"])]
