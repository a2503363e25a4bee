"""One named file of the parts that tasks have written.

Tasks write parts beside the file. The parts are strung together in a new file, which
then takes the old one's place at once; until that moment nothing of the old one is
touched, so whatever fails or ends before leaves it whole.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs as arrow
from pyspark.sql import SparkSession

from duelframe.sources.staging import hadoop

#: Bytes that a task copies at once.
SLICE = 8 << 20


def _address(fs, path) -> str:
    uri = fs.makeQualified(path).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def is_mounted(fs, path) -> bool:
    """Whether nodes see a path as their own file, so that tasks can write at any place of it."""
    return fs.makeQualified(path).toUri().getScheme() == "file"


def _copied(parts: list[tuple[str, int, int]], into: str, spread: bool):
    """A function for tasks: copies (address, bytes, place) to their places in a file, or all in a row to a new one."""

    def in_place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                store, name = arrow.FileSystem.from_uri(r.path)
                with store.open_input_stream(name) as source, open(into, "r+b") as out:
                    out.seek(r.place)
                    left = r.size
                    while left and (some := source.read(min(SLICE, left))):
                        out.write(some)
                        left -= len(some)
                yield pd.DataFrame({"size": [r.size - left]})

    def in_a_row(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, name = arrow.FileSystem.from_uri(into)
        with store.open_output_stream(name) as out:
            for batch in batches:
                for r in batch.sort_values("place").itertuples():
                    from_, source_name = arrow.FileSystem.from_uri(r.path)
                    with from_.open_input_stream(source_name) as source:
                        left = r.size
                        while left and (some := source.read(min(SLICE, left))):
                            out.write(some)
                            left -= len(some)
                    yield pd.DataFrame({"size": [r.size - left]})

    return in_place if spread else in_a_row


def string_together(spark: SparkSession, folder: str, path: str, head: bytes = b"", tail: bytes = b"", trim: int = 0) -> None:
    """Make path one file: head, the parts of folder in the order of their names without the last trim bytes, and tail.

    In a file system that nodes mount, every task writes its parts at their places; in
    another store one task writes them in a row. The driver holds the parts' names.
    """
    fs, at = hadoop(spark, path)
    parent = fs.makeQualified(at).getParent()
    fs.mkdirs(parent)
    found = [x for x in fs.listStatus(hadoop(spark, folder)[1]) if x.getPath().getName().startswith("part-") and x.getLen()]
    found.sort(key=lambda x: x.getPath().getName())
    parts, place = [], len(head)
    for k, x in enumerate(found):
        size = x.getLen() - trim * (k + 1 == len(found))
        parts.append((_address(fs, x.getPath()), size, place))
        place += size
    mounted = is_mounted(fs, at)
    made = f"{folder}/made"
    if mounted:
        name = hadoop(spark, made)[1].toUri().getPath()
        with open(name, "wb") as out:
            out.write(head)
            out.seek(place)
            out.write(tail)
            out.truncate()
        into, rows = name, parts
    else:
        ends = []
        for k, (text, where) in enumerate(((head, -1), (tail, place))):
            end = f"{folder}/end-{k}"
            stream = fs.create(hadoop(spark, end)[1])
            stream.write(bytearray(text))
            stream.close()
            ends.append((_address(fs, hadoop(spark, end)[1]), len(text), where))
        into, rows = _address(fs, hadoop(spark, made)[1]), [ends[0], *parts, ends[1]]
    if rows:
        frame = spark.createDataFrame(rows, "path string, size long, place long")
        frame = frame.repartition(len(rows)) if mounted else frame.coalesce(1)
        copied = sum(r.size for r in frame.mapInPandas(_copied(rows, into, mounted), "size long").collect())
        if copied != sum(size for _, size, _ in rows):
            raise RuntimeError(f"{path}: a part was shorter than it had been")
    swap(spark, made, path)


def swap(spark: SparkSession, made: str, path: str) -> None:
    """Put the file made in the place of path's, in one step."""
    fs, at = hadoop(spark, path)
    if fs.makeQualified(at).toUri().getScheme() == "file":
        name = at.toUri().getPath()
        fs.delete(hadoop(spark, f"{os.path.dirname(name) or '.'}/.{os.path.basename(name)}.crc")[1], False)  # checksums of the old bytes
        os.replace(hadoop(spark, made)[1].toUri().getPath(), name)
        return
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(hadoop(spark, made)[1], at, how)


@contextmanager
def parts_beside(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside path, of the same store, which goes at the end."""
    folder = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        fs, at = hadoop(spark, folder)
        fs.delete(at, True)


def write_one(spark: SparkSession, path: str, write: Callable[[str], None], **ends) -> None:
    """write(folder) writes the parts; path becomes the one file of them."""
    with parts_beside(spark, path) as folder:
        write(f"{folder}/parts")
        string_together(spark, f"{folder}/parts", path, **ends)
