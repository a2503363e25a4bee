"""Helpers that the corpus operators share."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.sources.staging import new_path, remove

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a few numbers that every task may be given, about 20 MB.
BROADCAST_ROWS = 1 << 18
#: Rows of a batch that goes to Python while a table is written.
BATCH_ROWS = 1000

_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share, in the application's own under spark.checkpoint.dir; see staging.

    Only a local master, as in tests, may leave the setting unset. Inside scratch the
    folder goes at its end, and otherwise with the application.
    """
    path = new_path(spark)
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """While a table is written, Python gets at most BATCH_ROWS rows at once: whole texts are long, and a task holds a batch several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = int(spark.conf.get(name))
    spark.conf.set(name, min(own, BATCH_ROWS) if own > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, own)


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again.

    This cuts the lineage: a lost executor costs no recomputation before this
    point. The files are compressed columns, so a later reader takes only the
    columns that it needs. discard removes the table; otherwise it goes with scratch
    or with the application.
    """
    path = shared_dir(df.sparkSession)
    with _small_batches(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Remove tables that materialize wrote and nothing reads any more; None is passed over."""
    for t in tables:
        if t is not None:
            remove(t.sparkSession, t.folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """What is materialised inside is removed at the end, except folders that are taken out of the list."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)


def written_out(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with its result written: its last pass gets small batches too, and all that it wrote besides is gone."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch(spark) as made:
            out = materialize(query(spark, sf_dir))
            made.remove(out.folder)
        return out

    return run


def lean(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The lesser side of a join, of keys and a few numbers, as a table; broadcast if it has at most `most` rows.

    Beyond that Spark chooses the join, and shuffles both sides by the keys.
    """
    side = materialize(side)
    return F.broadcast(side) if side.count() <= most else side


def id_bucket(id_col: Column, mod: int) -> Column:
    """crc32 of an id's text, modulo mod; null for a null id."""
    return F.crc32(id_col.cast("string")) % mod


def unit(h: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1."""
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def text_hash(text: Column, seed: int) -> Column:
    """64 bits for a text; null counts as empty. With two seeds they tell any texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(seed))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
