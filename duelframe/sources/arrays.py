"""JSON arrays of objects, read by as many tasks as their bytes are worth.

A file is cut in ranges of bytes. What a range's bytes mean hangs on whether its first
one is inside a string, and how deep in brackets: a first pass finds for each range, for
both cases, what holds at its end, and these few numbers give every range's beginning.
A second pass then reads each range, and the objects that begin in it to their ends.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyarrow import fs as arrow
from pyspark.sql import DataFrame, SparkSession

from duelframe.sources.staging import hadoop

#: Bytes of a range, and of what is read at first beyond one.
RANGE, MORE = 32 << 20, 64 << 10
#: Bytes that the first pass looks at together.
SLICE = 1 << 20
_STRING = rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_UPTO_BRACKET = re.compile(rb'[^{}\[\]"]*+(?:' + _STRING + rb'[^{}\[\]"]*+)*+([{}\[\]])', re.DOTALL)
_REST = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_OPEN, _CLOSE, _OBJECT = b"{[", b"}]", ord("{")

Read = Callable[[int, int], bytes]


def cut(read: Read, at: int, size: int) -> int:
    """The first place from `at` on whose byte no backslash stands before; so no range begins within an escape."""
    while 0 < at < size:
        some = read(at - 1, MORE)
        kept = len(some) - len(some.lstrip(b"\\"))
        if kept < len(some):
            return at + kept
        at += len(some)
    return min(at, size)


def ends(data: bytes) -> list[tuple[bool, int]]:
    """For a range that begins outside a string, and for one that begins inside: whether it ends inside one, and by how much it deepens."""
    parts = data.replace(b"\\\\", b"").replace(b'\\"', b"").split(b'"')  # every second part is outside
    out = []
    for inside in (0, 1):
        bare = b"".join(parts[inside::2])
        out.append((len(parts) % 2 == inside, sum(map(bare.count, (b"{", b"["))) - sum(map(bare.count, (b"}", b"]")))))
    return out


def ends_of(read: Read, start: int, end: int, size: int) -> list[tuple[bool, int]]:
    """What ends tells of a range, looked at in slices, so that the parts of no more than a slice are held."""
    told = [(False, 0), (True, 0)]
    while start < end:
        upto = min(max(cut(read, min(start + SLICE, end), size), start + 1), end)
        some = ends(read(start, upto - start))
        told = [(some[inside][0], depth + some[inside][1]) for inside, depth in told]
        start = upto
    return told


def after(data: bytes, inside: bool) -> tuple[bool, int]:
    """What ends tells of one of the two."""
    return ends(data)[inside]


def objects(read: Read, start: int, end: int, inside: bool, depth: int) -> Iterator[bytes]:
    """The array's objects that begin from start to before end; other elements are passed over."""
    data, own, more = read(start, end - start), end - start, MORE
    at = 0
    if inside:
        rest = _REST.match(data)
        if rest is None:
            return
        at = rest.end()
    while True:
        first = None
        for m in iter(_UPTO_BRACKET.scanner(data, at).match, None):
            place = m.end() - 1
            if data[place] in _OPEN:
                if depth == 1:
                    if place >= own:
                        return
                    first = place if data[place] == _OBJECT else None
                depth += 1
            else:
                depth -= 1
                if depth == 1 and first is not None:
                    yield data[first : place + 1]
                    first = None
        if first is None:
            return
        extra = read(start + len(data), more)
        if not extra:
            return
        data, start, own, at, depth, more = data[first:] + extra, start + first, own - first, 0, 1, 2 * more


def reader(path: str) -> Read:
    store, name = arrow.FileSystem.from_uri(path)
    file = store.open_input_file(name)
    size = file.size()
    return lambda at, n: file.read_at(max(0, min(n, size - at)), at)


def uri(status) -> str:
    """A file's address as tasks open it."""
    at = status.getPath().toUri()
    return f"{at.getScheme()}://{at.getAuthority() or ''}{at.getPath()}"


def array_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(address, bytes) of the files that path names."""
    fs, at = hadoop(spark, path)
    return [(uri(x), x.getLen()) for x in fs.globStatus(at) or [] if x.isFile()]


def opens(path: str) -> bool:
    """Whether tasks can open a file by its address; stores that only the JVM knows are read whole, by a task each."""
    try:
        reader(path)
    except (OSError, ValueError, ImportError, NotImplementedError):
        return False
    return True


def array_elements(spark: SparkSession, files: list[tuple[str, int]], size: int | None = None) -> DataFrame | None:
    """(value) the texts of the objects of JSON arrays; None if one of the files is no array.

    That is if it begins or ends with another character than a bracket, or its strings
    and brackets don't end with it. The driver holds a few numbers for each range.
    """
    size = size or RANGE
    ranges = [(path, at, min(at + size, length), length) for path, length in files for at in range(0, length, size)]
    if not ranges or any(not length for _, length in files):
        return None
    schema = "path string, start long, end long, size long"

    def dealt(rows: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(rows, schema).repartition(len(rows))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                read = reader(r.path)
                start, end = cut(read, r.start, r.size), cut(read, r.end, r.size)
                told = [x for case in ends_of(read, start, end, r.size) for x in case]
                data = read(start, end - start).strip()
                yield pd.DataFrame([(r.path, r.start, start, end, *told, data[:1] == b"[", data[-1:] == b"]")], columns=["path", "at", "start", "end", "in0", "by0", "in1", "by1", "opens", "closes"])

    known = dealt(ranges, schema).mapInPandas(look, "path string, at long, start long, end long, in0 boolean, by0 long, in1 boolean, by1 long, opens boolean, closes boolean").collect()
    begun = []
    for path, parts in groupby(sorted(known, key=lambda r: (r.path, r.at)), key=lambda r: r.path):
        inside, depth, rows = False, 0, list(parts)
        for r in rows:
            begun.append((path, r.start, r.end, inside, depth))
            inside, depth = (r.in1, depth + r.by1) if inside else (r.in0, depth + r.by0)
        if (inside, depth, rows[0].opens, [r.closes for r in rows if r.end > r.start][-1]) != (False, 0, True, True):
            return None

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                held: list[str] = []
                for value in objects(reader(r.path), r.start, r.end, r.inside, r.depth):
                    held.append(value.decode("utf-8", "replace"))
                    if len(held) == 1000:
                        yield pd.DataFrame({"value": held})
                        held = []
                yield pd.DataFrame({"value": held}, dtype=object)

    return dealt(begun, "path string, start long, end long, inside boolean, depth long").mapInPandas(take, "value string")
