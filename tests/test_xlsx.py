"""Workbooks read through the Python data source, one task per file."""

import os
import zipfile

from cohortlens.sources.xlsx import XlsxDataSource

SHEET = """<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData></worksheet>"""


def make_xlsx(path, rows):
    strings, out = [], []
    for i, r in enumerate(rows, start=1):
        cells = []
        for j, v in enumerate(r):
            ref = f"{chr(65 + j)}{i}"
            if v is None:
                continue
            if isinstance(v, str):
                strings.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>')
            else:
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
        out.append(f'<row r="{i}">{"".join(cells)}</row>')
    sst = ('<?xml version="1.0" encoding="UTF-8"?><sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", SHEET.format(rows="".join(out)))
        z.writestr("xl/sharedStrings.xml", sst)


def test_read_workbooks(spark, tmpdir_fresh):
    make_xlsx(os.path.join(tmpdir_fresh, "sql.xlsx"),
              [["User Name", "Course Name", "Progress (%)"], ["asha rao", "Basic SQL", "80%"], ["dev", "Basic SQL", None]])
    make_xlsx(os.path.join(tmpdir_fresh, "py.xlsx"),
              [["User Name", "Course Name", "Progress (%)"], ["isha", "Basic Python Programming", 55]])
    make_xlsx(os.path.join(tmpdir_fresh, "~$lock.xlsx"), [["x"]])
    spark.dataSource.register(XlsxDataSource)
    df = spark.read.format("xlsx").load(os.path.join(tmpdir_fresh, "*.xlsx"))
    rows = {(r["User Name"], r["Progress (%)"]) for r in df.collect()}
    assert rows == {("asha rao", "80%"), ("dev", None), ("isha", "55")}
    assert df.rdd.getNumPartitions() == 2
