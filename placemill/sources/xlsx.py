"""Rows of one worksheet as text, read from the zipped XML of a workbook (runs inside a task)."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# fixed values: built-in number formats that show dates, cell texts that mean "no value"
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_MISSING = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
}


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    dated = set(_DATE_FORMATS)
    for fmt in root.iter(f"{_M}numFmt"):
        bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", ""))
        if re.search("[ymdhs]", bare, re.I):
            dated.add(int(fmt.get("numFmtId")))
    formats = root.find(f"{_M}cellXfs")
    return {i for i, xf in enumerate(formats if formats is not None else ()) if int(xf.get("numFmtId", 0)) in dated}


def _sheet_file(book: zipfile.ZipFile, sheet: int | str) -> str:
    sheets = list(ET.fromstring(book.read("xl/workbook.xml")).iter(f"{_M}sheet"))
    if isinstance(sheet, str):
        chosen = next((s for s in sheets if s.get("name") == sheet), None)
        if chosen is None:
            raise ValueError(f"no worksheet named {sheet!r}")
    else:
        chosen = sheets[sheet]
    for link in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == chosen.get(_R):
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("worksheet without a file")


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _plain(item: ET.Element) -> str:
    """The text of a string item without its phonetic hints."""
    phonetic = {id(t) for hint in item.iter(f"{_M}rPh") for t in hint.iter(f"{_M}t")}
    return "".join(t.text or "" for t in item.iter(f"{_M}t") if id(t) not in phonetic)


def _epoch(book: zipfile.ZipFile) -> datetime:
    properties = ET.fromstring(book.read("xl/workbook.xml")).find(f"{_M}workbookPr")
    since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    return datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)


def _text(cell: ET.Element, shared: list[str], dated: set[int], epoch: datetime) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _plain(cell)
    if kind == "e":
        return ""
    node = cell.find(f"{_M}v")
    raw = node.text if node is not None and node.text is not None else ""
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind != "n" or raw == "":
        return raw
    number = float(raw)
    if int(cell.get("s", -1)) in dated:
        moment = epoch + timedelta(seconds=round(number * 86400))
        return moment.strftime("%Y-%m-%d %H:%M:%S")
    return str(int(number)) if number.is_integer() else repr(number)


def sheet_rows(content: bytes, sheet: int | str) -> Iterator[list[str]]:
    """Rows from the top of the sheet, blank ones included; missing values are ''."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_plain(item) for item in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_M}si")]
        dated, epoch = _date_styles(book), _epoch(book)
        expected = 1
        with book.open(_sheet_file(book, sheet)) as stream:
            for _, row in ET.iterparse(stream):
                if row.tag != f"{_M}row":
                    continue
                number = int(row.get("r", expected))
                for _ in range(number - expected):
                    yield []
                expected = number + 1
                values: list[str] = []
                for cell in row.iter(f"{_M}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(values)
                    values.extend([""] * (at - len(values)))
                    text = _text(cell, shared, dated, epoch)
                    values.append("" if text in _MISSING else text)
                yield values
                row.clear()
