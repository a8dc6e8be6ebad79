"""A workbook's sheet as rows, split by row ranges."""

import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from handoff.session import ensure_checkpoint_dir
from handoff.sources import tables as T
from handoff.sources import workbook as W
from tests.conftest import SMOKE


def scratch(spark):
    base = ensure_checkpoint_dir(spark)
    return f"{base}/book-{uuid.uuid4().hex[:8]}/t.xlsx"


@pytest.mark.parametrize("range_rows", [7, 50_000])
def test_a_table_reads_back_equal(spark, range_rows):
    df = spark.read.parquet(f"{SMOKE}/customer.parquet")
    path = scratch(spark)
    W.write_workbook(df, path, "E Comm", order_by=["c_custkey"])
    back = W.read_workbook(spark, path, "E Comm", schema=df.schema, range_rows=range_rows)
    assert back.schema == df.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    found = W.read_workbook(spark, path)
    assert dict(found.dtypes)["c_custkey"] == "bigint" and dict(found.dtypes)["c_acctbal"] == "double" and dict(found.dtypes)["c_name"] == "string"
    assert W.sheet_rows(spark, path, range_rows=7).rdd.getNumPartitions() == -(-151 // 7)


def test_cells_of_every_kind(spark):
    rows = [(1, "a <b> & \"c\"", 1.5, True, None), (2, " pad ", float("nan"), False, "x"), (3, None, -2e-7, None, "ü 北")]
    df = spark.createDataFrame(rows, "`a.b` long, t string, d double, f boolean, z string")
    path = scratch(spark)
    W.write_workbook(df, path)
    back = [tuple(r) for r in W.read_workbook(spark, path, schema=df.schema).collect()]
    assert sorted(back) == [(1, "a <b> & \"c\"", 1.5, True, None), (2, " pad ", None, False, "x"), (3, None, -2e-7, None, "ü 北")]
    assert W.read_workbook(spark, path, null_tokens=["x"]).where("z = 'x'").count() == 0
    with pytest.raises(Exception, match="no sheet"):
        W.sheet_rows(spark, path, "nope").count()


def test_shared_strings_gaps_and_missing_references(spark):
    path = scratch(spark)
    W.write_workbook(spark.range(1), path)
    local = path.removeprefix("file:")
    main = W._MAIN
    with zipfile.ZipFile(local) as old:
        files = {n: old.read(n) for n in old.namelist()}
    files["xl/sharedStrings.xml"] = (f'<sst xmlns="{main}"><si><t>Variable</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si></sst>').encode()
    files["xl/worksheets/sheet1.xml"] = (
        f'<worksheet xmlns="{main}"><sheetData><row r="2"><c r="B2" t="s"><v>0</v></c><c r="C2" t="str"><v>text</v></c></row>'
        f'<row r="5"><c r="B5" t="s"><v>1</v></c><c r="D5" t="e"><v>#N/A</v></c><c r="AA5"><v>7</v></c></row>'
        f'<row><c t="b"><v>1</v></c><c><v>3.0</v></c></row><row r="9"/></sheetData></worksheet>').encode()
    with zipfile.ZipFile(local, "w") as new:
        for n, data in files.items():
            new.writestr(n, data)
    got = {r["line"]: r["cells"] for r in W.sheet_rows(spark, path).collect()}
    assert got[2] == [None, "Variable", "text"] and got[5][:4] == [None, "two runs", None, None] and got[5][26] == "7" and got[6] == ["true", "3.0"]
    assert set(got) == {2, 5, 6}
    named = T.locate_header(W.sheet_columns(spark, path, width=3), "Variable", "line").collect()
    assert sorted(tuple(r) for r in named) == [("3.0", ""), ("two runs", "")]


@pytest.mark.parametrize("row", ['<row r="{0}" spans="1:1" x14ac:dyDescent="0.25">', '<row spans="1:1" r="{0}">', "<row r='{0}'>", "<row>", '<!-- x --><row r="{0}">'])
@pytest.mark.parametrize("chunk", [300, 1 << 20])
def test_ranges_pass_over_earlier_rows_and_lose_none(spark, monkeypatch, row, chunk):
    """rows before a range are passed over as bytes; what the bytes cannot tell is parsed."""
    monkeypatch.setattr(W, "CHUNK", chunk)
    path = scratch(spark)
    W.write_workbook(spark.range(1), path)
    local = path.removeprefix("file:")
    with zipfile.ZipFile(local) as old:
        files = {n: old.read(n) for n in old.namelist()}
    lines = [n for n in range(1, 60) if n % 7]
    body = "".join(f'{row.format(n)}<c t="inlineStr"><is><t>&lt;row r="99"&gt; {i}</t></is></c></row>' for i, n in enumerate(lines))
    files["xl/worksheets/sheet1.xml"] = (f'<?xml version="1.0"?><worksheet xmlns="{W._MAIN}" xmlns:x14ac="urn:x"><dimension ref="A1:A60"/><sheetData>{body}</sheetData>'
                                         '<rowBreaks count="0"/></worksheet>').encode()
    with zipfile.ZipFile(local, "w") as new:
        for n, data in files.items():
            new.writestr(n, data)
    whole = list(W.rows_of(path, None, 1, None))
    assert len(whole) == len(lines)
    for size in (1, 4, 50):
        assert [r for a in range(1, 61, size) for r in W.rows_of(path, None, a, a + size)] == whole
    assert list(W.rows_of(path, None, 61, None)) == []


def test_ranges_are_bounded(spark):
    """with a range for every few rows the passes over the sheet grew with the square of its rows."""
    path = scratch(spark)
    W.write_workbook(spark.range(1000), path, order_by=["id"])
    reader = W.WorkbookReader({"path": path, "rangeRows": "2"})
    parts = reader.partitions()
    assert len(parts) <= W.MAX_RANGES and [p.first for p in parts[1:]] == [p.last for p in parts[:-1]]
    assert W.read_workbook(spark, path, range_rows=2).agg(F.sum("id")).first()[0] == 499_500


def test_column_references():
    assert [W.column_number(r) for r in ("A1", "Z9", "AA10", "XFD1")] == [0, 25, 26, 16383]
    assert all(W.column_number(W.column_letters(n) + "7") == n for n in range(0, 16384, 37))
