"""Workbooks (xlsx) without a library: a reader as a Spark data source, and a writer for reports.

A workbook is a zip of XML files. The reader yields a row for each row of a sheet, as its number and a
map from column name to text, since files differ in columns; cells of a date format become ISO texts.
A file that can't be read yields one row with the error in its place, and the others go on.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from pathlib import PurePosixPath
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Ids of the built-in number formats that show dates.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
EPOCH = datetime(1899, 12, 30)
ROWS = "timeline string, row_idx long, cells map<string,string>, error string"


def _place(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _letters(place: int) -> str:
    out = ""
    place += 1
    while place:
        place, rest = divmod(place - 1, 26)
        out = chr(65 + rest) + out
    return out


def read_sheet(content: bytes, sheet: str) -> Iterator[dict[str, str]]:
    """The rows of a sheet under its first row's names, without empty cells."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        xml = lambda name: ElementTree.fromstring(z.read(name))
        names = set(z.namelist())
        targets = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
        found = [s for s in xml("xl/workbook.xml").iterfind("m:sheets/m:sheet", NS) if s.get("name") == sheet]
        if not found:
            raise ValueError(f"no sheet {sheet}")
        path = targets[found[0].get(REL)].lstrip("/")
        path = path if path.startswith("xl/") else f"xl/{path}"
        texts = ["".join(t.text or "" for t in s.iter(f"{{{NS['m']}}}t")) for s in xml("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        dated: list[bool] = []
        if "xl/styles.xml" in names:
            styles = xml("xl/styles.xml")
            own = {int(f.get("numFmtId")) for f in styles.iterfind("m:numFmts/m:numFmt", NS) if re.search("[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")), re.I)}
            dated = [int(x.get("numFmtId", 0)) in DATE_FORMATS | own for x in styles.iterfind("m:cellXfs/m:xf", NS)]

        def value(cell: ElementTree.Element) -> str | None:
            kind, v = cell.get("t"), cell.find("m:v", NS)
            if kind == "inlineStr":
                return "".join(t.text or "" for t in cell.iter(f"{{{NS['m']}}}t"))
            if v is None or v.text is None:
                return None
            if kind == "s":
                return texts[int(v.text)]
            if kind in (None, "n") and (style := int(cell.get("s", 0))) < len(dated) and dated[style]:
                return (EPOCH + timedelta(seconds=round(float(v.text) * 86400))).isoformat()
            if kind in (None, "n") and re.fullmatch(r"-?\d+\.0+", v.text):
                return v.text.split(".")[0]
            return v.text

        header: dict[int, str] | None = None
        with z.open(path) as stream:
            for _, element in ElementTree.iterparse(stream):
                if not element.tag.endswith("}row"):
                    continue
                cells = {_place(c.get("r")) if c.get("r") else k: value(c) for k, c in enumerate(element.iterfind("m:c", NS))}
                element.clear()
                if header is None:
                    header = {k: v for k, v in cells.items() if v}
                    continue
                yield {header[k]: v for k, v in cells.items() if k in header and v not in (None, "")}


def sheet_rows(spark: SparkSession, folder: str, sheet: str, names: Sequence[str] | None = None) -> DataFrame:
    """(timeline, row_idx, cells, error) of a sheet of all workbooks in a folder, by any path Spark can open.

    ``timeline`` is the file's name without its ending, ``row_idx`` the row's place in the file from 0.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder).select("path", "content")
    wanted = set(names) if names is not None else None

    def run(frames):
        import pandas as pd

        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                timeline, rows = PurePosixPath(path).stem, []
                try:
                    for k, cells in enumerate(read_sheet(content, sheet)):
                        rows.append((timeline, k, {n: v for n, v in cells.items() if wanted is None or n in wanted}, None))
                except Exception as problem:  # noqa: BLE001  any broken file is reported, not fatal
                    rows = [(timeline, None, None, f"{type(problem).__name__}: {problem}")]
                yield pd.DataFrame(rows, columns=["timeline", "row_idx", "cells", "error"]).astype({"row_idx": "Int64"})

    return files.mapInPandas(run, ROWS)


def write_workbook(path: str, sheets: dict[str, tuple[Sequence[str], Sequence[Sequence], Sequence[int]]], fills: dict[str, str] | None = None) -> None:
    """A workbook of sheets, each (headers, rows, widths): bold headers, frozen, filtered, rows filled by a cell's value.

    ``fills`` maps a value to a colour; a row is filled by the first of its cells that has one. Reports
    are for people, so this runs on the driver with rows that were collected for it.
    """
    colours = list(dict.fromkeys((fills or {}).values()))
    fill = lambda c: f'<fill><patternFill patternType="solid"><fgColor rgb="FF{c}"/></patternFill></fill>'
    styles = (
        f'<styleSheet xmlns="{NS["m"]}"><fonts count="2"><font/><font><b/></font></fonts>'
        f'<fills count="{len(colours) + 3}"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fill("D9E1F2")}{"".join(map(fill, colours))}</fills>'
        f'<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(colours) + 2}"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/>'
        f'{"".join(f"<xf fillId=\"{k + 3}\" applyFill=\"1\"/>" for k in range(len(colours)))}</cellXfs></styleSheet>'
    )

    def cell(value, row: int, place: int, style: int) -> str:
        if value is None or value == "":
            return ""
        at = f'r="{_letters(place)}{row}" s="{style}"'
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f"<c {at}><v>{value}</v></c>"
        clean = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
        return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
        relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name={quoteattr(name)} sheetId="{k}" r:id="rId{k}"/>' for k, name in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{NS["m"]}" xmlns:r="{relation}"><sheets>{listed}</sheets></workbook>')
        parts = "".join(f'<Relationship Id="rId{k}" Type="{relation}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{parts}<Relationship Id="rId0" Type="{relation}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", styles)
        for k, (headers, rows, widths) in enumerate(sheets.values(), 1):
            last = _letters(max(len(headers) - 1, 0))
            columns = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
            body = [f'<row r="1">{"".join(cell(h, 1, i, 1) for i, h in enumerate(headers))}</row>']
            for n, values in enumerate(rows, 2):
                style = next((colours.index(fills[v]) + 2 for v in values if fills and isinstance(v, str) and v in fills), 0)
                body.append(f'<row r="{n}">{"".join(cell(v, n, i, style) for i, v in enumerate(values))}</row>')
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{NS["m"]}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{columns}</cols><sheetData>{"".join(body)}</sheetData><autoFilter ref="A1:{last}{len(body)}"/></worksheet>')
