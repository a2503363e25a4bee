"""CSV whose values hold line ends, read by as many tasks as its bytes are worth.

A file is cut after line ends, so a range begins either with a row or inside quotes. A
first pass finds for each range, for both cases, which of them holds at its end, and
these few bits give every range's beginning. A second pass then reads each range, and
the rows that begin in it to their ends. A quote is doubled inside quotes, and opens a
value only at its beginning.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from duelframe.sources import arrays
from duelframe.sources.arrays import Read
from duelframe.sources.staging import hadoop

#: Bytes of a range, and of what is looked at together for a line end or for more of a row.
RANGE, MORE = 32 << 20, 64 << 10
_QUOTED = rb'[^"]*+(?:""[^"]*+)*+"'
_VALUE = rb'(?:"' + _QUOTED + rb'|(?!"))[^,\n]*+'
_REST = rb"(?:," + _VALUE + rb")*+\n"
_ROW, _INSIDE = re.compile(_VALUE + _REST), re.compile(_QUOTED + rb"[^,\n]*+" + _REST)


def cut(read: Read, at: int, size: int) -> int:
    """The first place from `at` on that follows a line end; the file's ends stay."""
    at -= at > 0
    while 0 < at < size:
        some = read(at, MORE)
        found = some.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(some)
    return min(at, size)


def ends(data: bytes, inside: bool) -> bool:
    """Whether a range that ends with a line end leaves off inside quotes."""
    first = _INSIDE.match(data) if inside else None
    if inside and first is None:
        return True
    at = first.end() if first else 0
    for m in iter(_ROW.scanner(data, at).match, None):
        at = m.end()
    return at < len(data)


def rows(read: Read, start: int, end: int, inside: bool, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, bytes without the line end) of the rows that begin from start to before end."""

    def upto(at: int, last: int) -> bytes:
        some = read(at, last - at)
        return some + b"\n" if last == size and some and not some.endswith(b"\n") else some

    data, at, more = upto(start, end), 0, MORE
    if inside:
        first = _INSIDE.match(data)
        if first is None:
            return
        at = first.end()
    for m in iter(_ROW.scanner(data, at).match, None):
        yield start + at, m.group()[:-1]
        at = m.end()
    if at == len(data):
        return
    place, row = start + at, data[at:]
    while end < size and not _ROW.match(row):
        end, more = cut(read, min(end + more, size), size), 2 * more
        row = upto(place, end)
    whole = _ROW.match(row)
    yield place, whole.group()[:-1] if whole else read(place, size - place)  # quotes that nothing closes hold the file's rest


def csv_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(address, bytes) of the file, or of the files of the folder, that Spark reads at path."""
    fs, at = hadoop(spark, path)
    found = [y for x in fs.globStatus(at) or [] for y in (fs.listStatus(x.getPath()) if x.isDirectory() else [x])]
    return [(arrays.uri(x), x.getLen()) for x in found if x.isFile() and not x.getPath().getName().startswith(("_", "."))]


def csv_rows(spark: SparkSession, files: list[tuple[str, int]], size: int | None = None) -> DataFrame | None:
    """(file, place, value) the rows of CSV files as texts, without headers and empty rows; None if a file's line ends are carriage returns alone.

    The driver holds a few bits for each range.
    """
    size = size or RANGE
    ranges = [(path, at, min(at + size, length), length) for path, length in files for at in range(0, length, size)]

    def dealt(known: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(known, schema).repartition(len(known))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                read = arrays.reader(r.path)
                start, end = cut(read, r.start, r.size), cut(read, r.end, r.size)
                data = read(start, end - start)
                line = data[: data.find(b"\n") + 1] or data.replace(b"\r", b"\r\r")  # what the first line ends with
                yield pd.DataFrame([(r.path, start, end, r.size, ends(data, False), ends(data, True), line.endswith(b"\r\n"), b"\r\r" in line and b"\n" not in line)], columns=["path", "start", "end", "size", "in0", "in1", "two", "odd"])

    known = dealt(ranges, "path string, start long, end long, size long").mapInPandas(look, "path string, start long, end long, size long, in0 boolean, in1 boolean, two boolean, odd boolean").collect()
    begun = []
    for path, parts in groupby(sorted(known, key=lambda r: (r.path, r.start, r.end)), key=lambda r: r.path):
        inside, two = False, None
        for r in parts:
            if r.start == r.end:
                continue
            if two is None:
                if r.odd:
                    return None
                two = r.two
            begun.append((path, r.start, r.end, inside, r.size, two))
            inside = r.in1 if inside else r.in0

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                held: list[tuple] = []
                header = r.start == 0
                for place, value in rows(arrays.reader(r.path), r.start, r.end, r.inside, r.size):
                    bare = value.removesuffix(b"\r").replace(b"\r\n", b"\n") if r.two else value
                    if not bare:
                        continue
                    if header:
                        header = False
                        continue
                    held.append((r.path, place, bare.decode("utf-8", "replace")))
                    if len(held) == 1000:
                        yield pd.DataFrame(held, columns=["file", "place", "value"])
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=["file", "place", "value"])

    return dealt(begun, "path string, start long, end long, inside boolean, size long, two boolean").mapInPandas(take, "file string, place long, value string")
