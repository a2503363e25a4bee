"""A workbook of one sheet, for people to fill in."""

from __future__ import annotations

import io
import re
import zipfile
from itertools import chain
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

# Fixed values of the format: the most rows of a sheet and characters of a cell, and what XML can't hold.
MOST_ROWS, MOST_CHARACTERS = 1_048_576, 32_767
_BARRED = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_NS = "http://schemas.openxmlformats.org/"
_PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_NS}package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{_NS}package/2006/relationships"><Relationship Id="rId1" Type="{_NS}officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook xmlns="{_NS}spreadsheetml/2006/main" xmlns:r="{_NS}officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_NS}package/2006/relationships"><Relationship Id="rId1" Type="{_NS}officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


class _Out(io.RawIOBase):
    """A Hadoop output stream as a Python file."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytearray(data))
        return len(data)


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c><v>{value}</v></c>"
    text = escape(_BARRED.sub("", str(value))[:MOST_CHARACTERS])
    return f'<c t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def write_sheet(df: DataFrame, path: str) -> None:
    """Write df as the workbook path, in any file system that Spark knows: a header, then the rows in df's order.

    Rows stream through the driver, a partition at a time; a ValueError, and no file,
    if they are more than a sheet holds. Longer texts are cut at a cell's limit.
    """
    if df.limit(MOST_ROWS).count() >= MOST_ROWS:
        raise ValueError(f"a sheet holds {MOST_ROWS - 1} rows and a header; write CSV")
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    with io.BufferedWriter(_Out(stream), 1 << 20) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in _PARTS.items():
            book.writestr(name, _HEAD + text)
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'{_HEAD}<worksheet xmlns="{_NS}spreadsheetml/2006/main"><sheetData>'.encode())
            for row in chain([df.columns], df.toLocalIterator()):
                sheet.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
            sheet.write(b"</sheetData></worksheet>")
    stream.close()
