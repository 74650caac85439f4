"""Cells of one worksheet, read as a stream from the XML parts of a workbook file."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import IO
from xml.etree import ElementTree as ET

# Fixed values of the workbook format: built-in number formats that hold a date or a time.
DATE_FORMATS = frozenset((*range(14, 23), *range(45, 48)))
EPOCH = datetime(1899, 12, 30)

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.attrib["numFmtId"])
        for f in root.iter(f"{_MAIN}numFmt")
        if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.attrib["formatCode"].lower()))
    }
    formats = root.find(f"{_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in formats] if formats is not None else []
    return {i for i, number in enumerate(ids) if number in DATE_FORMATS or number in custom}


def _sheet_part(book: zipfile.ZipFile, sheet: str | int) -> str:
    """``auto`` is the first visible sheet; else a position or a name."""
    root = ET.fromstring(book.read("xl/workbook.xml"))
    sheets = list(root.iter(f"{_MAIN}sheet"))
    if sheet == "auto":
        chosen = next((s for s in sheets if s.get("state", "visible") == "visible"), sheets[0])
    elif isinstance(sheet, int):
        chosen = sheets[sheet]
    else:
        chosen = next(s for s in sheets if s.get("name") == sheet)
    links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.attrib["Target"] for r in links if r.get("Id") == chosen.get(_LINK))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _value(cell: ET.Element, texts: list[str], dates: set[int]) -> object:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    raw = cell.findtext(f"{_MAIN}v")
    if raw is None:
        return None
    if kind == "s":
        return texts[int(raw)]
    if kind == "b":
        return raw == "1"
    if kind != "n":
        return raw
    number = float(raw) if re.search(r"[.eE]", raw) else int(raw)
    if int(cell.get("s", 0)) in dates:
        return EPOCH + timedelta(days=number)
    return number


def sheet_rows(stream: IO[bytes], sheet: str | int = "auto") -> Iterator[list[object]]:
    """Rows in order; rows the file leaves out come as empty lists."""
    with zipfile.ZipFile(stream) as book:
        texts, dates = _texts(book), _date_styles(book)
        with book.open(_sheet_part(book, sheet)) as part:
            expected = 1
            for _, element in ET.iterparse(part):
                if element.tag != f"{_MAIN}row":
                    continue
                number = int(element.get("r", expected))
                for _ in range(expected, number):
                    yield []
                expected = number + 1
                row: list[object] = []
                for cell in element.iter(f"{_MAIN}c"):
                    at = _column(cell.attrib["r"]) if "r" in cell.attrib else len(row)
                    row.extend([None] * (at - len(row)))
                    row.append(_value(cell, texts, dates))
                yield row
                element.clear()
