"""Spreadsheet (xlsx) reader (S3) without a JVM plugin.

Files are listed and read by Spark's ``binaryFile`` source; each workbook is
one row, parsed inside a ``mapInPandas`` task with the standard library
(``zipfile`` + streaming XML).  An xlsx is a zip archive and cannot be split,
so one workbook is one unit of work.  A task holds the file's bytes and its shared
strings; the sheet itself is read as a stream, handed back in chunks of
:data:`CHUNK_ROWS` rows, and each row's elements are freed.  Excel caps a sheet
at 1,048,576 rows x 16,384 columns.  Many workbooks spread over many tasks.

Headers keep every column apart: the second column of one header is named
``header_2`` (and so on), a column with data but no header ``_col<n>`` by its
place from the start column.

Two shapes are offered:

* :func:`read_workbook_cells` - one row per non-empty data cell
  ``(_source_file, row, col, header, text, number, kind)``; no schema needed.
  ``kind`` is n (number), d (a number whose style shows a date), b (boolean),
  e (error) or s (text).
* :func:`read_workbooks` - one row per sheet row with a column per header,
  like a spreadsheet data source with ``header=true``.  The schema is given,
  or inferred by one aggregation over headers and cells: columns of numbers
  only become double, of dates timestamp, of booleans boolean, the rest string,
  columns without data too.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)

from clinilake.names import col as column

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL_REF = re.compile(r"^([A-Z]+)(\d+)$")
_ADDRESS = re.compile(r"^(?:'?(?P<sheet>[^'!]*)'?!)?(?P<cell>[A-Za-z]+\d+)$")

CELL_SCHEMA = StructType([
    StructField("_source_file", StringType()), StructField("row", LongType()),
    StructField("col", LongType()), StructField("header", StringType()),
    StructField("text", StringType()), StructField("number", DoubleType()),
    StructField("kind", StringType()),
])

# Numbers of the built-in date and time formats.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_NOT_CODES = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]|_.|\*.')


def parse_address(address: str) -> tuple[str | None, int, int]:
    """``"'sheet1'!B3"`` -> ``("sheet1", 3, 2)`` (1-based row and column)."""
    m = _ADDRESS.match(address.strip())
    if not m:
        raise ValueError(f"bad data address {address!r}")
    cm = _CELL_REF.match(m.group("cell").upper())
    return (m.group("sheet") or None), int(cm.group(2)), column_number(cm.group(1))


def column_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n


def _sheet_member(zf: zipfile.ZipFile, sheet: str | None) -> str:
    book = ET.fromstring(zf.read("xl/workbook.xml"))
    sheets = book.findall("m:sheets/m:sheet", _NS)
    if not sheets:
        raise ValueError("workbook has no sheets")
    chosen = sheets[0]
    if sheet is not None:
        matches = [s for s in sheets if s.get("name") == sheet]
        if not matches:
            raise ValueError(f"sheet {sheet!r} not found")
        chosen = matches[0]
    rel_id = chosen.get(f"{{{_NS['r']}}}id")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", _NS):
        if rel.get("Id") == rel_id:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise ValueError(f"no relationship for sheet {chosen.get('name')!r}")


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    try:
        root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
    except KeyError:
        return []
    return ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t"))
            for si in root.findall("m:si", _NS)]


def _date_styles(zf: zipfile.ZipFile) -> frozenset[int]:
    """The cell styles whose number format shows a date or time."""
    try:
        root = ET.fromstring(zf.read("xl/styles.xml"))
    except KeyError:
        return frozenset()
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.findall("m:numFmts/m:numFmt", _NS)}

    def dated(number: int) -> bool:
        if number not in own:
            return number in _DATE_FORMATS
        code = _NOT_CODES.sub("", own[number]).lower()
        return code != "general" and any(c in code for c in "ymdhs")

    return frozenset(i for i, xf in enumerate(root.findall("m:cellXfs/m:xf", _NS))
                     if dated(int(xf.get("numFmtId", "0"))))


def _from_1904(zf: zipfile.ZipFile) -> bool:
    options = ET.fromstring(zf.read("xl/workbook.xml")).find("m:workbookPr", _NS)
    return options is not None and options.get("date1904") in ("1", "true")


def serial_text(serial: float, from_1904: bool = False) -> str | None:
    """A date serial as ``yyyy-MM-dd HH:mm:ss``; null outside the years 1 to 9999.

    Day 60 of the 1900 system is a 29 February that never was; days before it
    are counted from one day later.
    """
    if from_1904:
        base = dt.datetime(1904, 1, 1)
    else:
        base = dt.datetime(1899, 12, 30) if serial >= 60 else dt.datetime(1899, 12, 31)
    try:
        return (base + dt.timedelta(seconds=round(serial * 86400))).strftime("%Y-%m-%d %H:%M:%S")
    except OverflowError:
        return None


def iter_cells(content: bytes, sheet: str | None = None
               ) -> Iterator[tuple[int, int, str | None, float | None]]:
    """Yield ``(row, col, text, number)`` for each non-empty cell of a sheet."""
    for row, col, text, number, _ in iter_typed_cells(content, sheet):
        yield row, col, text, number


def iter_typed_cells(content: bytes, sheet: str | None = None
                     ) -> Iterator[tuple[int, int, str | None, float | None, str]]:
    """Yield ``(row, col, text, number, kind)`` for each non-empty cell of a sheet.

    Numbers keep both forms: ``number`` as parsed and ``text`` as written, or
    as a date where the cell's style shows one.  Booleans become ``TRUE``/``FALSE``; errors keep their ``#`` text.  Row
    and cell references are optional in the format: a row without ``r``
    follows the previous row, a cell without ``r`` the previous cell.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        strings, dated, from_1904 = _shared_strings(zf), _date_styles(zf), _from_1904(zf)
        member = _sheet_member(zf, sheet)
        with zf.open(member) as fh:
            c_tag, v_tag, is_tag = (f"{{{_NS['m']}}}c", f"{{{_NS['m']}}}v",
                                    f"{{{_NS['m']}}}is")
            row_tag = f"{{{_NS['m']}}}row"
            row, col = 0, 0
            data_tag = f"{{{_NS['m']}}}sheetData"
            parent = None
            for event, el in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    if el.tag == data_tag:
                        parent = el
                    if el.tag == row_tag:
                        row = int(el.get("r")) if el.get("r") else row + 1
                        col = 0
                    continue
                if el.tag == row_tag:
                    el.clear()
                    if parent is not None:
                        parent.clear()  # else each emptied row stays under the sheet
                    continue
                if el.tag != c_tag:
                    continue
                ref = _CELL_REF.match(el.get("r", ""))
                if ref is not None:
                    row, col = int(ref.group(2)), column_number(ref.group(1))
                else:
                    col += 1
                kind, out = el.get("t", "n"), "s"
                v = el.find(v_tag)
                raw = v.text if v is not None else None
                text, number = None, None
                if kind == "s" and raw is not None:
                    text = strings[int(raw)]
                elif kind == "inlineStr":
                    box = el.find(is_tag)
                    text = "".join(t.text or "" for t in box.iter(f"{{{_NS['m']}}}t")) if box is not None else None
                elif kind == "b" and raw is not None:
                    text, out = ("TRUE" if raw.strip() == "1" else "FALSE"), "b"
                elif kind in ("str", "e"):
                    text, out = raw, "e" if kind == "e" else "s"
                elif raw is not None:
                    text = raw
                    try:
                        number, out = float(raw), "n"
                    except ValueError:
                        number = None
                    if number is not None and int(el.get("s", "0")) in dated:
                        shown = serial_text(number, from_1904)
                        if shown is not None:
                            text, out = shown, "d"
                el.clear()
                if text is None and number is None:
                    continue
                yield row, col, text, number, out


CHUNK_ROWS = 20_000  # sheet rows per batch handed back to Spark


def _header_names(cells: dict[int, str | None], start_col: int) -> dict[int, str]:
    """A name for each header cell, repeated ones numbered from the second on."""
    names: dict[int, str] = {}
    used: set[str] = set()
    for c in sorted(cells):
        if not cells[c]:
            continue
        name, k = cells[c], 1
        while name in used:
            k += 1
            name = f"{cells[c]}_{k}"
        used.add(name)
        names[c] = name
    return names


def _cell_chunks(path: str, content: bytes, sheet: str | None, start_row: int,
                 start_col: int, chunk_rows: int = CHUNK_ROWS, headers_too: bool = False
                 ) -> Iterator[pd.DataFrame]:
    """Data cells of one sheet, ``chunk_rows`` sheet rows at a time.

    Sheet XML lists rows in order, so the header row comes first and a chunk
    boundary never splits a row; a task holds one chunk, not the sheet.
    ``headers_too`` adds a row without a value for each named column.
    """
    columns = [f.name for f in CELL_SCHEMA]
    found: dict[int, str | None] = {}
    names: dict[int, str] | None = None
    buf: list[tuple] = []
    rows_in_buf, last_row = 0, None

    def named() -> dict[int, str]:
        out = _header_names(found, start_col)
        if headers_too:
            buf.extend((path, start_row, c, name, None, None, None) for c, name in out.items())
        return out

    for r, c, t, n, kind in iter_typed_cells(content, sheet):
        if r < start_row or c < start_col:
            continue
        if r == start_row:
            found[c] = t
            continue
        if names is None:
            names = named()
        if r != last_row:
            if rows_in_buf >= chunk_rows:
                yield pd.DataFrame(buf, columns=columns)
                buf, rows_in_buf = [], 0
            rows_in_buf, last_row = rows_in_buf + 1, r
        buf.append((path, r, c, names.get(c) or f"_col{c - start_col + 1}", t, n, kind))
    if names is None:
        named()
    if buf:
        yield pd.DataFrame(buf, columns=columns)


def _files(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    """The workbooks under ``path``, whatever the case of their ending."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xX]")
            .option("recursiveFileLookup", str(recursive).lower()).load(path)
            .select("path", "content"))


def _cells(spark: SparkSession, path: str, data_address: str, recursive: bool, headers_too: bool) -> DataFrame:
    sheet, start_row, start_col = parse_address(data_address)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"]):
                yield from _cell_chunks(p, bytes(content), sheet, start_row, start_col, headers_too=headers_too)

    return _files(spark, path, recursive).mapInPandas(parse, CELL_SCHEMA)


def read_workbook_cells(spark: SparkSession, path: str, data_address: str = "A1",
                        recursive: bool = False) -> DataFrame:
    """One row per non-empty data cell, header attached (see module doc)."""
    return _cells(spark, path, data_address, recursive, headers_too=False)


def infer_schema(cells: DataFrame) -> StructType:
    """Header order and types from one aggregation over the cells.

    The result has one row for each distinct header of all the workbooks, the
    only thing brought to the driver.  Rows without a value (the headers
    themselves) make a column known without a say in its type.
    """
    kinds = {"n": DoubleType(), "d": TimestampType(), "b": BooleanType()}
    stats = (cells.where(F.col("header").isNotNull())
             .groupBy("header")
             .agg(F.min("col").alias("pos"), F.count("kind").alias("filled"),
                  *[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
             .orderBy("pos", "header").collect())
    return StructType([
        StructField(r["header"], next((t for k, t in kinds.items() if r["filled"] and r[k] == r["filled"]), StringType()))
        for r in stats])


def read_workbooks(spark: SparkSession, path: str, data_address: str = "A1",
                   schema: StructType | None = None, recursive: bool = False) -> DataFrame:
    """Wide rows, one per sheet row, columns named by the header row.

    Rows without any value are skipped, as spreadsheet readers do.  Numeric
    cells going into a string column keep their written text.
    """
    sheet, start_row, start_col = parse_address(data_address)
    if schema is None:
        schema = infer_schema(_cells(spark, path, data_address, recursive, headers_too=True))
    names = [f.name for f in schema]
    numeric = {f.name for f in schema if isinstance(f.dataType, (DoubleType, LongType))}
    out_schema = StructType([StructField(f.name, DoubleType() if f.name in numeric else StringType())
                             for f in schema] + [StructField("_source_file", StringType())])
    files = _files(spark, path, recursive)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"]):
                for cells in _cell_chunks(p, bytes(content), sheet, start_row, start_col):
                    yield from _wide(cells, p)

    def _wide(cells: pd.DataFrame, p: str) -> Iterator[pd.DataFrame]:
        """One chunk of cells as wide rows (whole sheet rows only)."""
        cells = cells[cells["header"].isin(names)]
        if cells.empty:
            return
        value = cells["number"].where(cells["header"].isin(numeric), None)
        text = cells["text"].where(~cells["header"].isin(numeric), None)
        cells = cells.assign(value=value.astype(object).where(value.notna(), text))
        wide = cells.pivot_table(index="row", columns="header", values="value", aggfunc="first")
        wide = wide.reindex(columns=names)
        for name in names:
            if name in numeric:
                wide[name] = pd.to_numeric(wide[name], errors="coerce")
            else:
                wide[name] = pd.Series([None if pd.isna(v) else str(v) for v in wide[name]],
                                       index=wide.index, dtype=object)
        wide["_source_file"] = p
        yield wide.reset_index(drop=True)

    df = files.mapInPandas(parse, out_schema)
    return df.select([column(f.name).cast(f.dataType).alias(f.name) for f in schema]
                     + [F.col("_source_file")])
