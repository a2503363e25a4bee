"""Uploads as they arrive: the clean table grows by what it doesn't have."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from duelframe.functions import patterns as P
from duelframe.operators.events import first_of_each
from duelframe.operators.incremental import new_rows
from duelframe.plans.battles import make_uploads_1v1
from duelframe.sources.files import UPLOADS


def read_uploads(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the NDJSON files that come into folder."""
    return spark.readStream.schema(UPLOADS).json(folder)


def add_uploads(stream: DataFrame, target: str, checkpoint: str, names: Mapping[str, str] | None = None, league: str = P.LEAGUE) -> StreamingQuery:
    """Clean each batch and append the battles with ids that target, a Parquet folder, doesn't have.

    A batch that is tried again adds nothing twice. Within a batch the first row of
    an id in the order of its columns counts.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != "id"]
        clean = make_uploads_1v1(first_of_each(batch, "id", rest), names, league)
        existing = spark.createDataFrame([], clean.schema).select("id")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            existing = spark.read.schema(clean.schema).parquet(target).select("id")
        new_rows(clean, existing).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
