"""Tables that are written once and read again, in a folder that all nodes share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, str] = {}


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of the JVM, whatever store the path is in."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = hadoop(spark, path)
    fs.delete(at, True)


def application_folder(spark: SparkSession) -> str:
    """The application's own folder, under spark.checkpoint.dir; only a local master may leave that unset.

    It goes when the session is stopped, or else when the JVM ends. What a killed JVM
    leaves has the application's id in its name.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _made:
        return _made[app]
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="duelframe-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    folder = f"{base.rstrip('/')}/duelframe-{app}"
    fs, at = hadoop(spark, folder)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    stop = sc.stop

    def stop_and_remove() -> None:
        if _made.pop(app, None):
            fs.delete(at, True)
        stop()

    sc.stop = stop_and_remove
    _made[app] = folder
    return folder


def new_path(spark: SparkSession) -> str:
    """A name in the application's folder that nothing has yet."""
    return f"{application_folder(spark)}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """df written as Parquet and read again: what comes after doesn't compute it anew, even if an executor is lost."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
