"""A video service's REST interface: a channel's uploads, page by page and batch by batch.

Ids come from a Python data source, whose pages follow one another and so make one
partition. Their metadata is fetched by the executors in batches of ids, and its
nested JSON is flattened by Spark.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from duelframe.operators.incremental import new_rows
from duelframe.sources import files
from duelframe.sources.staging import staged

# Fixed values of the service's interface.
API = "https://www.googleapis.com/youtube/v3"
WATCH = "https://www.youtube.com/watch?v="
KEY_VARIABLE, KEY_FIELD = "YOUTUBE_API_KEY", "YT_API_KEY"
PAGE, PACE, TIMEOUT = 50, 0.2, 30

ITEM = "struct<id: string, snippet: struct<title: string, description: string, publishedAt: string, tags: array<string>>, statistics: struct<viewCount: string, likeCount: string, commentCount: string>, contentDetails: struct<duration: string>>"


def api_key(secret_path: str | None = None) -> str:
    """The key from the environment, or else from a JSON file. It is looked up where it is used, and is in no plan."""
    key = os.environ.get(KEY_VARIABLE)
    if not key and secret_path and os.path.exists(secret_path):
        with open(secret_path, encoding="utf-8") as f:
            key = json.load(f).get(KEY_FIELD)
    if not key:
        raise RuntimeError(f"no API key: set {KEY_VARIABLE}, or {KEY_FIELD} in the secret file")
    return key


def get_json(api: str, what: str, secret: str | None, **params: object) -> dict:
    url = f"{api}/{what}?{urllib.parse.urlencode(params | {'key': api_key(secret)})}"
    try:
        with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:
            return json.load(answer)
    except (urllib.error.URLError, TimeoutError) as e:
        raise RuntimeError(f"{what} can't be fetched: {getattr(e, 'reason', e)}") from None


def uploads_playlist(channel: str, api: str = API, secret: str | None = None) -> str:
    said = get_json(api, "channels", secret, part="contentDetails", id=channel)
    try:
        return said["items"][0]["contentDetails"]["relatedPlaylists"]["uploads"]
    except (KeyError, IndexError):
        raise ValueError(f"channel {channel} has no uploads playlist") from None


class _Ids(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        api, secret = o.get("api", API), o.get("secret")
        more = {"playlistId": uploads_playlist(o["channel"], api, secret), "part": "contentDetails", "maxResults": PAGE}
        place = 0
        while True:
            said = get_json(api, "playlistItems", secret, **more)
            for item in said.get("items", []):
                if found := item.get("contentDetails", {}).get("videoId"):
                    yield place, found
                    place += 1
            if not said.get("nextPageToken"):
                return
            more["pageToken"] = said["nextPageToken"]
            time.sleep(float(o.get("pace", PACE)))


class _NewIds(DataSourceStreamReader):
    """Ids newer than the newest one seen; the service lists the newest first."""

    def __init__(self, options: dict):
        self.options = options

    def _pages(self, playlist: str | None = None) -> Iterator[tuple[str, list[str]]]:
        """(playlist, ids) of one page after the other."""
        o = self.options
        api, secret = o.get("api", API), o.get("secret")
        playlist = playlist or uploads_playlist(o["channel"], api, secret)
        more = {"playlistId": playlist, "part": "contentDetails", "maxResults": PAGE}
        while True:
            said = get_json(api, "playlistItems", secret, **more)
            yield playlist, [v for x in said.get("items", []) if (v := x.get("contentDetails", {}).get("videoId"))]
            if not said.get("nextPageToken"):
                return
            more["pageToken"] = said["nextPageToken"]
            time.sleep(float(o.get("pace", PACE)))

    def initialOffset(self) -> dict:
        return {"newest": None, "playlist": None}

    def latestOffset(self) -> dict:
        playlist, ids = next(self._pages())
        return {"newest": ids[0] if ids else None, "playlist": playlist}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition((start["newest"], end["newest"], end["playlist"]))] if end["newest"] not in (None, start["newest"]) else []

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """The ids from end's down to before start's. If start's is gone, all down to the last; if end's is, from the first."""
        start, end, playlist = partition.value
        ids: list[str] = []
        for _, page in self._pages(playlist):
            ids += page
            if start in page:
                ids = ids[: ids.index(start)]
                break
        yield from enumerate(ids[ids.index(end) :] if end in ids else ids)


class ChannelUploads(DataSource):
    """The ids of a channel's uploads, in their order: spark.read or spark.readStream, .format("channel_uploads").option("channel", ...).

    A stream reads pages only down to the newest id that it has seen.
    """

    @classmethod
    def name(cls) -> str:
        return "channel_uploads"

    def schema(self) -> str:
        return "place long, id string"

    def reader(self, schema) -> DataSourceReader:
        return _Ids(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _NewIds(dict(self.options))


def fetch_metadata(ids: DataFrame, api: str = API, secret: str | None = None, pace: float = PACE, tasks: int = 1) -> DataFrame:
    """The uploads' metadata by id, in batches of PAGE. tasks is how many fetch at once, each at its own pace."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = batch["id"].tolist()
            for at in range(0, len(names), PAGE):
                said = get_json(api, "videos", secret, part="snippet,contentDetails,statistics", id=",".join(names[at : at + PAGE]))
                yield pd.DataFrame({"item": [json.dumps(x) for x in said.get("items", [])]})
                time.sleep(pace)

    items = ids.where("id is not null").select("id").repartition(tasks).mapInPandas(fetch, "item string")
    return flatten_items(items.repartition(ids.sparkSession.sparkContext.defaultParallelism))


def flatten_items(items: DataFrame) -> DataFrame:
    """The service's JSON items as rows of the uploads table; absent texts are empty, absent counts null."""
    x = items.select(F.from_json("item", ITEM).alias("x")).select("x.*")
    text = lambda c: F.coalesce(c, F.lit(""))
    return x.select(
        "id",
        text(F.col("snippet.title")).alias("title"),
        text(F.col("snippet.description")).alias("description"),
        text(F.col("snippet.publishedAt")).alias("upload_date"),
        F.col("statistics.viewCount").alias("view_count"),
        text(F.col("contentDetails.duration")).alias("duration"),
        F.when(text(F.col("id")) != "", F.concat(F.lit(WATCH), "id")).otherwise("").alias("url"),
        F.col("statistics.likeCount").alias("likeCount"),
        F.col("statistics.commentCount").alias("commentCount"),
        F.coalesce("snippet.tags", F.array().cast("array<string>")).alias("tags"),
    )


def _channel(spark: SparkSession, reader, channel: str, api: str, secret: str | None, pace: float):
    spark.dataSource.register(ChannelUploads)
    reader = reader.format("channel_uploads").options(channel=channel, api=api, pace=pace)
    return reader.option("secret", secret) if secret else reader


def stream_channel_uploads(spark: SparkSession, channel: str, path: str, checkpoint: str, api: str = API, secret: str | None = None, pace: float = PACE) -> StreamingQuery:
    """Add a channel's uploads since the last run to the JSON array or folder at path; all that are there now, then the stream ends.

    The checkpoint holds the newest id, so a run without new uploads asks for one page
    of ids and nothing else. A batch that is tried again adds nothing twice: what path
    has already is left out.
    """
    ids = _channel(spark, spark.readStream, channel, api, secret, pace).load()

    def add(batch: DataFrame, _: int) -> None:
        existing = files.load_existing(batch.sparkSession, path)
        fresh = staged(fetch_metadata(new_rows(batch, existing), api, secret, pace))
        if not fresh.isEmpty():
            files.add_uploads(existing, fresh, path)

    return ids.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fetch_channel_uploads(spark: SparkSession, channel: str, path: str, api: str = API, secret: str | None = None, pace: float = PACE) -> int:
    """Add a channel's new uploads to the JSON array or folder of NDJSON at path; how many there were. Nothing new leaves it alone."""
    ids = _channel(spark, spark.read, channel, api, secret, pace).load()
    existing = files.load_existing(spark, path)
    fresh = staged(fetch_metadata(new_rows(ids, existing), api, secret, pace))
    n = fresh.count()
    if n:
        files.add_uploads(existing, fresh, path)
    return n
