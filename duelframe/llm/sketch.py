"""Count-min sketches that tasks fill, Spark merges and every task can ask.

A sketch has some tables, each of `depth` rows of 2**bits cells (Cormode and
Muthukrishnan 2005). A key adds its count to one cell of each row, so the least of its
cells is never below its count. Only whether a count reaches `cap` is ever asked, so
cells stop there: merged cells below it are exact sums, and nothing that reaches it is
lost. Tasks hand on their cells in compressed pages; the pages of a place are added up
one by one, and one bit for each cell is left, which is what tasks are given: its size
follows from the parameters alone and not from the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from duelframe.llm.common import materialize

#: Cells of a page, as a power of two.
PAGE = 14
#: Splits of the input that a task takes.
SPLITS = 4
PAGES = "place int, cells binary"
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SHIFT = np.uint64(33)


def gathered(df: DataFrame, splits: int = SPLITS) -> DataFrame:
    """df with several splits to a task, one after the other and without a shuffle, as long as all cores have work.

    What a task sums up and hands on grows less than what it reads: its pages not at
    all, and its counts as its distinct keys.
    """
    now = df.rdd.getNumPartitions()
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-now // splits)))


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all hang on all bits of h."""
    h = (h ^ (h >> _SHIFT)) * _MIX[0]
    h = (h ^ (h >> _SHIFT)) * _MIX[1]
    return h ^ (h >> _SHIFT)


def cells_of(h: np.ndarray, depth: int, bits: int) -> Iterator[np.ndarray]:
    """The cell of each key in each row, from mixed hashes."""
    step, mask = (h >> np.uint64(32)) | np.uint64(1), np.uint64((1 << bits) - 1)
    for _ in range(depth):
        yield (h & mask).astype(np.int64)
        h = h + step


class CountMin:
    """The cells of one task."""

    def __init__(self, cap: int, tables: int, depth: int, bits: int):
        if bits < PAGE or not 0 < cap < 1 << 30:
            raise ValueError(f"a sketch has at least 2**{PAGE} cells in a row, and a cap below 2**30")
        self.cap, self.bits = cap, bits
        self.cells = np.zeros((tables, depth, 1 << bits), np.uint16 if cap < 1 << 14 else np.uint32)

    def add(self, table: int, h: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Count keys with mixed hashes h, once each or counts times; a key may come more than once."""
        most, top = 1, np.iinfo(self.cells.dtype).max
        if counts is not None:
            counts = np.minimum(counts, self.cap).astype(self.cells.dtype)
            most = int(counts.max(initial=1))
        step = (int(top) - self.cap) // most  # so many at once can't run over
        for at in range(0, len(h), step):
            by = self.cells.dtype.type(1) if counts is None else counts[at : at + step]
            for row, cell in zip(self.cells[table], cells_of(h[at : at + step], self.cells.shape[1], self.bits), strict=True):
                np.add.at(row, cell, by)
                row[cell] = np.minimum(row[cell], self.cap)

    def pages(self) -> Iterator[pd.DataFrame]:
        """(place, cells) of the pages that aren't empty."""
        codec, kind = pa.Codec("zstd"), _kind(self.cap)
        for first, row in enumerate(self.cells.reshape(-1, 1 << self.bits)):
            pages = row.reshape(-1, 1 << PAGE)
            full = np.flatnonzero(pages.any(axis=1))
            if len(full):
                yield pd.DataFrame({"place": first * len(pages) + full, "cells": [codec.compress(pages[k].astype(kind).tobytes(), asbytes=True) for k in full]})


def _kind(cap: int) -> np.dtype:
    return np.min_scalar_type(cap)


class Reached:
    """Which cells reach the cap: what tasks are given."""

    def __init__(self, tables: int, depth: int, bits: int):
        self.bits = bits
        self.held = np.zeros((tables, depth, 1 << bits - 3), np.uint8)

    def put(self, place: int, page: bytes) -> None:
        self.held.reshape(-1, 1 << PAGE - 3)[place] = np.frombuffer(page, np.uint8)

    def __call__(self, table: int, h: np.ndarray) -> np.ndarray:
        """Whether keys with mixed hashes h may have been counted cap times; false only if they weren't."""
        out = np.ones(len(h), bool)
        for row, cell in zip(self.held[table], cells_of(h, self.held.shape[1], self.bits), strict=True):
            out &= (row[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return out


def merge(pages: DataFrame, cap: int, tables: int, depth: int, bits: int) -> Reached:
    """Add up the tasks' pages, in tasks by place; the driver receives a bit for each cell."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec, kind, sums = pa.Codec("zstd"), _kind(cap), {}
        size = np.dtype(kind).itemsize << PAGE
        for batch in batches:
            for place, cells in zip(batch["place"], batch["cells"], strict=True):
                page = np.frombuffer(codec.decompress(cells, decompressed_size=size), kind)
                if place in sums:
                    np.minimum(sums[place] + page, cap, out=sums[place], casting="unsafe")
                else:
                    sums[place] = page.astype(np.uint16 if cap < 1 << 14 else np.uint32)
        for place, page in sums.items():
            yield pd.DataFrame({"place": [place], "cells": [np.packbits(page >= cap, bitorder="little").tobytes()]})

    out = Reached(tables, depth, bits)
    for row in materialize(pages.repartition("place").mapInPandas(add, PAGES)).toLocalIterator():
        out.put(row.place, row.cells)
    return out
