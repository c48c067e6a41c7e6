"""First sheets of .xlsx files read and written with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_IDS = frozenset((*range(14, 23), *range(45, 48)))


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_rows(data: bytes) -> list[list[str | None]]:
    """The cells of the first sheet as text; numbers without `.0`, dates in ISO form."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        dates = set()
        if "xl/styles.xml" in names:
            styles = ElementTree.fromstring(z.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")) for f in styles.iter(f"{{{_NS['m']}}}numFmt") if re.search(r"[dmy]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower())}
            formats = styles.find("m:cellXfs", _NS)
            for i, xf in enumerate(formats if formats is not None else []):
                if int(xf.get("numFmtId", 0)) in _DATE_IDS | own:
                    dates.add(i)
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        first = book.find("m:sheets/m:sheet", _NS).get(_REL)
        links = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in links if r.get("Id") == first)
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        out = []
        for row in ElementTree.fromstring(z.read(path)).iter(f"{{{_NS['m']}}}row"):
            cells: list[str | None] = []
            for c in row.findall("m:c", _NS):
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                kind, v = c.get("t"), c.find("m:v", _NS)
                if kind == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                elif v is None or v.text is None:
                    continue
                elif kind == "s":
                    cells[at] = shared[int(v.text)]
                elif kind == "b":
                    cells[at] = "True" if v.text == "1" else "False"
                elif kind in ("str", "e"):
                    cells[at] = v.text
                elif int(c.get("s", 0)) in dates:
                    cells[at] = (datetime(1899, 12, 30) + timedelta(days=float(v.text))).isoformat(" ").removesuffix(" 00:00:00")
                else:
                    number = float(v.text)
                    cells[at] = str(int(number)) if number.is_integer() and abs(number) < 1e15 else v.text
            out.append(cells)
        return out


def write_rows(rows: Iterable[Iterable[object]]) -> bytes:
    """A workbook with one sheet; every cell is text, null is empty."""
    lines = []
    for i, row in enumerate(rows, 1):
        cells = "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' if v is not None else "<c/>" for v in row)
        lines.append(f'<row r="{i}">{cells}</row>')
    main = _NS["m"]
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str]) -> None:
        self.names, self.paths = [f.name for f in schema.fields], paths

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            rows = read_rows(f.read())
        heads = [(h or "").strip() for h in rows[0]] if rows else []
        at = {h: i for i, h in enumerate(heads)}
        for n, row in enumerate(rows[1:], 2):
            got = {"_src_file": partition.path, "_src_row": n}
            yield tuple(got[c] if c in got else row[at[c]] if c in at and at[c] < len(row) else None for c in self.names)


class XlsxSource(DataSource):
    """`spark.read.format("xlsx_sheet").load(path)`: one partition per file, all cells text, and `_src_file`, `_src_row`."""

    @classmethod
    def name(cls) -> str:
        return "xlsx_sheet"

    def _paths(self) -> list[str]:
        import glob

        path = self.options["path"].removeprefix("file://").removeprefix("file:")
        return sorted(p for p in glob.glob(path) if p.endswith((".xlsx", ".xlsm")))

    def schema(self) -> str:
        names: list[str] = []
        for path in self._paths():
            with open(path, "rb") as f:
                rows = read_rows(f.read())
            names += [(h or "").strip() for h in (rows[0] if rows else []) if (h or "").strip() not in names]
        return ", ".join([*(f"`{n}` string" for n in names if n), "_src_file string", "_src_row bigint"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self._paths())
