"""A1 / A2: a sheet of a workbook (Office Open XML, .xlsx) as a batch source of rows.

A sheet is one compressed XML stream inside the file, and the format bounds it (1,048,576 rows of 16,384
cells). It is read as a stream: a task passes over the bytes before its range and parses only its own rows, so
memory is one row and the sheet's shared strings; there are at most ``MAX_RANGES`` ranges, so the bytes are
passed over a bounded number of times. Cells come as text, as they are stored: numbers in
their shortest form, booleans as true / false, errors and empty cells as null. Dates are stored as numbers.

``read_workbook`` names the columns by a header row and casts them to a schema, given or found: a column
whose cells are all numbers is a double, or a long where all are whole and none is missing.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, NumericType, StructType

from handoff.functions.columns import col_of

#: Rows of one task's range, and rows of one Arrow batch.
RANGE_ROWS, BATCH_ROWS = 50_000, 5_000
#: Most ranges of a sheet, and bytes passed over at a time.
MAX_RANGES, CHUNK = 64, 1 << 20
ROW_SCHEMA = "line long, cells array<string>"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _open(path: str):
    uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    fs, name = pafs.FileSystem.from_uri(uri)
    return fs, name


def column_number(reference: str) -> int:
    """0 for A, 25 for Z, 26 for AA, of a cell reference like AB12."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def column_letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def sheet_file(book: zipfile.ZipFile, sheet: str | None) -> str:
    """Name in the file of a sheet given by name; the first sheet by default."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = {s.get("name"): s.get(f"{{{_LINKS}}}id") for s in root.iter(f"{{{_MAIN}}}sheet")}
    if sheet is not None and sheet not in sheets:
        raise ValueError(f"no sheet {sheet!r}; there are {', '.join(sheets)}")
    wanted = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links.iter(f"{{{_PACKAGE}}}Relationship") if r.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _text(node) -> str:
    """The text of a string item; phonetic guides are not part of it."""
    parts = [t.text or "" for t in node.findall(f"{{{_MAIN}}}t")]
    return "".join(parts + [t.text or "" for run in node.findall(f"{{{_MAIN}}}r") for t in run.findall(f"{{{_MAIN}}}t")])


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, node in ElementTree.iterparse(f):
            if node.tag == f"{{{_MAIN}}}si":
                out.append(_text(node))
                node.clear()
    return out


def _cell(node, strings: Sequence[str]) -> str | None:
    kind, value = node.get("t", "n"), node.find(f"{{{_MAIN}}}v")
    if kind == "inlineStr":
        return _text(node.find(f"{{{_MAIN}}}is"))
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value.text)]
    if kind == "b":
        return "true" if value.text.strip() == "1" else "false"
    return value.text


_ROW = re.compile(rb"<row\s(?:[^>]*?\s)?r=\"(\d+)\"")
_ROOT = re.compile(rb"<worksheet\s[^>]*>")


class _Rest:
    """A stream with some bytes put back in front."""

    def __init__(self, front: bytes, stream):
        self._front, self._stream = front, stream

    def read(self, n: int = -1) -> bytes:
        front, self._front = self._front, b""
        return front or self._stream.read(n)


def from_row(stream, first: int):
    """The sheet's stream without the rows before ``first``, found by the numbers in their tags.

    None where the bytes alone do not tell: rows without a number, other tags than plain ``<row>``, comments or
    quoted sections.
    """
    held, root = b"", None
    while chunk := stream.read(CHUNK):
        held += chunk
        if root is None and (found := _ROOT.search(held)) and f'xmlns="{_MAIN}"'.encode() in found[0]:
            root = held[: found.end()]
        end = held.rfind(b">") + 1  # tags beyond may be cut
        at = held.rfind(b"<row", 0, end)
        rows = held.count(b"<row", 0, end)
        plain = rows == held.count(b'<row r="', 0, end) or rows == sum(1 for _ in _ROW.finditer(held, 0, end))
        if b"<!" in held or not plain or (root is None and len(held) > 4 * CHUNK) or (at < 0 and len(held) > 4 * CHUNK):
            return None
        if at >= 0 and root is None:
            return None
        if at >= 0 and int(_ROW.match(held, at)[1]) >= first:
            at = next(m.start() for m in _ROW.finditer(held) if int(m[1]) >= first)
            return _Rest(root + b"<sheetData>" + held[at:], stream)
        held = held[at:] if at >= 0 else held
    return _Rest(b"<worksheet/>", stream) if held.startswith(b"<row") else None


def rows_of(path: str, sheet: str | None, first: int, last: int | None) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 1, cells) of the rows from ``first`` to ``last`` (excluded; None: to the end) that have cells."""
    fs, name = _open(path)
    with fs.open_input_file(name) as raw, zipfile.ZipFile(raw) as book:
        strings, line, file = shared_strings(book), 0, sheet_file(book, sheet)
        with book.open(file) as passed, book.open(file) as whole:
            f = (from_row(passed, first) if first > 1 else None) or whole
            for _, node in ElementTree.iterparse(f):
                if node.tag != f"{{{_MAIN}}}row":
                    continue
                line = int(node.get("r") or line + 1)
                if last is not None and line >= last:
                    return
                if line >= first:
                    cells: list[str | None] = []
                    for c in node.findall(f"{{{_MAIN}}}c"):
                        at = column_number(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at - len(cells))
                        cells.append(_cell(c, strings))
                    if cells:
                        yield line, cells
                node.clear()


class Rows(InputPartition):
    def __init__(self, first: int, last: int | None):
        self.first, self.last = first, last


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.sheet = options["path"], options.get("sheet")
        self.range_rows = int(options.get("rangeRows", RANGE_ROWS))

    def partitions(self) -> list[Rows]:
        """Ranges by the sheet's stated dimension, at most ``MAX_RANGES``; one to the end where it states none."""
        fs, name = _open(self.path)
        with fs.open_input_file(name) as raw, zipfile.ZipFile(raw) as book, book.open(sheet_file(book, self.sheet)) as f:
            stated = re.search(rb"<(?:\w+:)?dimension[^>]*ref=\"[A-Z]+\d+:[A-Z]+(\d+)\"", f.read(4096))
        lines = int(stated[1]) if stated else 0
        size = max(self.range_rows, -(-lines // MAX_RANGES))
        ends = list(range(size + 1, lines + 1, size))
        return [Rows(a, b) for a, b in zip([1, *ends], [*ends, None])]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        lines, cells = [], []
        for line, row in rows_of(self.path, self.sheet, partition.first, partition.last):
            lines.append(line)
            cells.append(row)
            if len(lines) >= BATCH_ROWS:
                yield self._batch(lines, cells)
                lines, cells = [], []
        if lines:
            yield self._batch(lines, cells)

    @staticmethod
    def _batch(lines: list[int], cells: list[list[str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(cells, pa.list_(pa.string()))], names=["line", "cells"])


class Workbook(DataSource):
    """``spark.read.format("workbook").option("sheet", name).load(path)``: (line, cells)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ROW_SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)


def sheet_rows(spark: SparkSession, path: str, sheet: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(line, cells) of a sheet's rows."""
    spark.dataSource.register(Workbook)
    reader = spark.read.format("workbook").option("rangeRows", range_rows)
    return (reader.option("sheet", sheet) if sheet is not None else reader).load(path)


def sheet_columns(spark: SparkSession, path: str, sheet: str | None = None, width: int = 2) -> DataFrame:
    """(line, c0, c1, ...): the first cells of every row as columns, as ``locate_header`` reads them."""
    rows = sheet_rows(spark, path, sheet)
    return rows.select("line", *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(width)])


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None, schema: str | StructType | None = None,
                  null_tokens: Sequence[str] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """A1/A3: the rows below the first row, named by it; ``schema`` gives the types, else they are found."""
    rows = sheet_rows(spark, path, sheet, range_rows)
    head = rows.first()  # ranges are in order, and so are a range's rows: the other ranges are not read
    if head is None:
        raise ValueError(f"the sheet of {path} is empty")
    names = [n if n is not None else f"column {column_letters(i)}" for i, n in enumerate(head["cells"])]
    body = rows.where(F.col("line") > head["line"])
    cells = [F.get("cells", F.lit(i)) for i in range(len(names))]
    if null_tokens:
        cells = [F.when(~c.isin(list(null_tokens)), c) for c in cells]
    table = body.select(*[c.alias(n) for c, n in zip(cells, names)])
    if schema is not None:
        types = {f.name: f.dataType for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields}
        return table.select(*[_as(col_of(n), types[n]).alias(n) for n in names if n in types])
    asked = []
    for i, n in enumerate(names):
        number = col_of(n).try_cast("double")
        asked += [F.count(col_of(n)).alias(f"n{i}"), F.count(number).alias(f"d{i}"), F.count_if(number == F.floor(number)).alias(f"w{i}")]
    found = table.agg(*asked, F.count(F.lit(1)).alias("rows")).first()
    kinds = ["string" if not found[f"n{i}"] or found[f"d{i}"] < found[f"n{i}"] else "bigint" if found[f"w{i}"] == found["rows"] else "double"
             for i in range(len(names))]
    return table.select(*[(c if k == "string" else c.cast("double").cast(k)).alias(n) for c, k, n in zip(map(col_of, names), kinds, names)])


def _as(c: F.Column, kind) -> F.Column:
    """The cell's text in the wanted type; whole numbers may be stored with a fraction of zeros."""
    if isinstance(kind, NumericType):
        return F.coalesce(c.try_cast(kind), c.try_cast("double").try_cast(kind))
    return c.try_cast(kind) if isinstance(kind, BooleanType) else c.cast(kind)


# ---------------------------------------------------------------- writing
def write_workbook(df: DataFrame, path: str, sheet: str = "Sheet1", order_by: Sequence[str] = ()) -> None:
    """Write the rows as the only sheet of a workbook, row by row (it is one file by its format)."""
    rows = df.orderBy(*map(col_of, order_by)) if order_by else df
    total = df.count()
    fs, name = _open(path)
    fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(name) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", (
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'))
        book.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}"><Relationship Id="r1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}"><Relationship Id="r1" Type="{_LINKS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with book.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f'<worksheet xmlns="{_MAIN}"><dimension ref="A1:{column_letters(len(df.columns) - 1)}{total + 1}"/><sheetData>'.encode())
            out.write(_row(1, df.columns))
            for line, r in enumerate(rows.toLocalIterator(), 2):
                out.write(_row(line, list(r)))
            out.write(b"</sheetData></worksheet>")


def _row(line: int, cells: list) -> bytes:
    parts = []
    for i, v in enumerate(cells):
        at = f"{column_letters(i)}{line}"
        if v is None or v != v:
            continue
        if isinstance(v, bool):
            parts.append(f'<c r="{at}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)):
            parts.append(f'<c r="{at}"><v>{v!r}</v></c>')
        else:
            parts.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
    return f'<row r="{line}">{"".join(parts)}</row>'.encode()
