"""Excel workbooks as a Spark data source (Python Data Source API).

One input partition per workbook, so a folder of course sheets is read in
parallel, one task per file. Cells are parsed with the standard library
(an .xlsx file is a zip of XML parts); every value is returned as text,
which is what the bronze layer expects. The first row is the header.

    spark.dataSource.register(XlsxDataSource)
    spark.read.format("xlsx").option("sheet", "1").load("/data/lms/*.xlsx")

Paths must be visible to the executors (a shared mount); the file list is
expanded on the driver.
"""

from __future__ import annotations

import glob
import re
import zipfile
import xml.etree.ElementTree as ET

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def read_rows(path: str, sheet: int = 1):
    """Yield each row of a worksheet as a list of strings (None for empty)."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            for si in root.findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        root = ET.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
        for row in root.iter(f"{{{_NS['m']}}}row"):
            cells, at = {}, -1
            for c in row.findall("m:c", _NS):
                # A cell without a reference stands right of the one before it.
                at = _col_index(c.get("r")) if c.get("r") else at + 1
                kind, v = c.get("t"), c.find("m:v", _NS)
                if kind == "s" and v is not None:
                    val = shared[int(v.text)]
                elif kind == "inlineStr":
                    val = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                else:
                    val = v.text if v is not None else None
                cells[at] = val
            width = max(cells) + 1 if cells else 0
            yield [cells.get(i) for i in range(width)]


class _Workbook(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class XlsxReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self):
        return [_Workbook(p) for p in _expand(self.options)]

    def read(self, partition):
        sheet = int(self.options.get("sheet", "1"))
        rows = read_rows(partition.path, sheet)
        header = next(rows, None)
        if header is None:
            return
        pos = {name: i for i, name in enumerate(header)}
        for r in rows:
            if not any(x not in (None, "") for x in r):
                continue
            yield tuple(r[pos[f.name]] if f.name in pos and pos[f.name] < len(r) else None
                        for f in self.schema.fields)


def _expand(options: dict) -> list[str]:
    pattern = options.get("path") or options.get("paths")
    files = sorted(p for p in glob.glob(pattern) if not p.split("/")[-1].startswith("~$"))
    return files


class XlsxDataSource(DataSource):
    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        files = _expand(self.options)
        if not files:
            return StructType([])
        header = next(read_rows(files[0], int(self.options.get("sheet", "1"))), [])
        return StructType([StructField(h, StringType()) for h in header if h])

    def reader(self, schema):
        return XlsxReader(schema, self.options)
