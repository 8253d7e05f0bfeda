"""Workbooks: each file's sheets as rows of cells.  Unzipping is the one step in Python; the rest is grids.

Cells hold text, a number's text, TRUE or FALSE; formulas give their cached value.  A
number whose style is that of a date or time is the text of that date or time.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Namespaces, file name endings and the mark of a lock file.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
ENDINGS, LOCK = (".xlsx", ".xlsm"), "~$"
# Numbers of the built-in formats that show a date or a time.
DATED = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
#: Cells of one sheet; a larger one is an error, never cut.
MAX_CELLS = 2_000_000
#: Bytes of workbooks that go to a Python worker at once.
BATCH_BYTES = 8 << 20

_ROWS = "path string, modified_at timestamp, sheet string, hidden boolean, row_number int, cells array<string>, region string"


def column_number(reference: str) -> int:
    """1 for A1, 28 for AB7."""
    n = 0
    for c in reference:
        if c.isalpha():
            n = 26 * n + ord(c.upper()) - 64
    return n


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def shows_date(code: str) -> bool:
    """Whether a format's code has a part of a date or time, apart from what it quotes, escapes, and puts in brackets (but elapsed time)."""
    first = re.sub(r'"[^"]*"|[\\_*].|\[(?![hms]+\])[^\]]*\]', "", code.split(";")[0], flags=re.IGNORECASE)
    return bool(re.search(r"[dmyhs]", first, re.IGNORECASE))


def date_text(number: str, since_1904: bool = False) -> str:
    """A serial number of days as a date and time, to the second or, where it has them, microseconds; one below a day as a time.  What is no number or beyond the calendar stays."""
    try:
        days = float(number)
        # The first calendar has a 29 February 1900, which is number 60.
        start = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 31 if days < 60 else 30)
        at = start + dt.timedelta(milliseconds=round(days * 86_400_000))
    except (ValueError, OverflowError):
        return number
    return str(at.time()) if 0 <= days < 1 else str(at)


def _styles(z: zipfile.ZipFile) -> list[bool]:
    """Whether each cell style shows a date."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {f.get("numFmtId"): shows_date(f.get("formatCode", "")) for f in root.iter(f"{MAIN}numFmt")}
    cells = root.find(f"{MAIN}cellXfs")
    kinds = [x.get("numFmtId", "0") for x in cells] if cells is not None else []
    return [own[k] if k in own else int(k) in DATED for k in kinds]


def _cell(c: ElementTree.Element, shared: list[str], dated: list[bool], since_1904: bool) -> str | None:
    kind, v = c.get("t"), c.find(f"{MAIN}v")
    if kind == "inlineStr":
        return _text(c)
    if v is None or v.text is None:
        return None
    if kind in (None, "n") and dated and dated[int(c.get("s", 0))]:
        return date_text(v.text, since_1904)
    return shared[int(v.text)] if kind == "s" else ("TRUE" if v.text == "1" else "FALSE") if kind == "b" else v.text


def sheets(data: bytes, chosen: Sequence[str] | None = None) -> Iterator[tuple[str, bool, int | None, list | None, str | None]]:
    """(sheet, hidden, row number, cells, None) of each row and (sheet, hidden, None, None, region) of each merged region.

    ``chosen``: the sheets that are read; one that the workbook lacks is an error.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = [_text(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        listed, dated = list(book.iter(f"{MAIN}sheet")), _styles(z)
        since_1904 = any(p.get("date1904") in ("1", "true") for p in book.iter(f"{MAIN}workbookPr"))
        if chosen and (missing := set(chosen) - {s.get("name") for s in listed}):
            raise ValueError(f"no worksheet named {sorted(missing)}; there are {[s.get('name') for s in listed]}")
        for s in listed:
            name, hidden = s.get("name"), s.get("state", "visible") != "visible"
            if chosen and name not in chosen:
                continue
            n, at = 0, 0
            with z.open(posixpath.normpath(posixpath.join("/xl", targets[s.get(LINK)]))[1:]) as part:
                for _, node in ElementTree.iterparse(part):
                    if node.tag == f"{MAIN}row":
                        at = int(node.get("r", at + 1))
                        cells: list[str | None] = []
                        for c in node.iter(f"{MAIN}c"):
                            k = column_number(c.get("r", "")) or len(cells) + 1
                            cells += [None] * (k - 1 - len(cells)) + [_cell(c, shared, dated, since_1904)]
                        n += len(cells)
                        if n > MAX_CELLS:
                            raise ValueError(f"sheet {name!r} has more than {MAX_CELLS} cells")
                        yield name, hidden, at, cells, None
                        node.clear()
                    elif node.tag == f"{MAIN}mergeCell":
                        yield name, hidden, None, None, node.get("ref")


def _reader(chosen: Sequence[str] | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    columns = [c.split()[0] for c in _ROWS.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, modified_at, content in zip(frame["path"], frame["modificationTime"], frame["content"]):
                rows: list[tuple] = []
                for row in sheets(content, chosen):
                    rows.append((path, modified_at, *row))
                    if len(rows) == 4096:
                        yield pd.DataFrame(rows, columns=columns).astype({"row_number": "Int32"})
                        rows = []
                yield pd.DataFrame(rows, columns=columns).astype({"row_number": "Int32"})

    return read


def scan(spark: SparkSession, folder: str, hidden: bool = False, chosen: Sequence[str] | None = None) -> DataFrame:
    """Rows and merged regions of the workbooks in a folder and below it; lock files are left out.  One row tells one file's row or region.

    ``chosen``: names of the sheets that are read, hidden or not; without them all visible ones are, and with ``hidden`` all.
    """
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where((name.endswith(ENDINGS[0]) | name.endswith(ENDINGS[1])) & ~name.startswith(LOCK))
    return from_bytes(files.select("path", "modificationTime", "content"), hidden, chosen)


def from_bytes(files: DataFrame, hidden: bool = False, chosen: Sequence[str] | None = None) -> DataFrame:
    """The same of workbooks that are in a table (path, modificationTime, content)."""
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    rows = files.mapInPandas(_reader(chosen), _ROWS)
    return rows if hidden or chosen else rows.where(~F.col("hidden"))


def grid(rows: DataFrame) -> DataFrame:
    """(sheet, row_number, cells) for the grid operators; a sheet is named by its file and its own name."""
    return rows.where("row_number is not null").select(F.struct("path", "sheet").alias("sheet"), "row_number", "cells")


def regions(rows: DataFrame) -> DataFrame:
    """(sheet, top, left, bottom, right) of merged cells; references may carry dollar signs."""
    ends = F.split(F.upper(F.translate("region", "$", "")), ":")
    letters = lambda i: F.regexp_extract(ends[i], "^([A-Z]+)", 1)
    number = lambda i: F.aggregate(F.filter(F.split(letters(i), ""), lambda c: c != ""), F.lit(0), lambda n, c: n * 26 + F.ascii(c) - 64)
    row = lambda i: F.regexp_extract(ends[i], "([0-9]+)$", 1).cast("int")
    return rows.where("region is not null").select(F.struct("path", "sheet").alias("sheet"), row(0).alias("top"), number(0).alias("left"), row(1).alias("bottom"), number(1).alias("right"))


def packed(rows: list[list[str | dt.datetime | None]], merges: tuple[str, ...] = (), sheet: str = "Data") -> bytes:
    """A workbook of one sheet of texts and dates."""
    letters = lambda k: chr(64 + k) if k <= 26 else letters((k - 1) // 26) + letters((k - 1) % 26 + 1)
    serial = lambda v: (v - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
    cell = lambda i, k, v: f'<c r="{letters(k)}{i}" s="1"><v>{serial(v)!r}</v></c>' if isinstance(v, dt.datetime) else f'<c r="{letters(k)}{i}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
    body = "".join(f'<row r="{i}">{"".join(cell(i, k, v) for k, v in enumerate(r, 1) if v is not None)}</row>' for i, r in enumerate(rows, 1))
    merged = f"<mergeCells>{''.join(f'<mergeCell ref={chr(34)}{m}{chr(34)}/>' for m in merges)}</mergeCells>" if merges else ""
    kinds = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{kinds}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{kinds}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN[1:-1]}"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN[1:-1]}"><sheetData>{body}</sheetData>{merged}</worksheet>')
    return out.getvalue()
