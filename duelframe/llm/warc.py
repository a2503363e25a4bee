"""WARC archives in Zstandard: a dictionary in a leading skippable frame, then a frame for each record.

Tasks write archives of a bounded size to a folder that the cluster shares, through
any file system that pyarrow knows, and hand back a manifest of the files; only what
the manifest names counts, so files of lost or repeated tasks do no harm. Reading
takes one archive a task and holds one record at a time; headers, lengths and
digests are validated.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.common import materialize, shared_dir, table

#: Payloads of fewer bytes are never written as revisits.
LEAST_REVISIT = 100
#: Bytes of records, before compression, after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: The dictionary's size, and the most bytes and records of an archive's start that train it.
DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLE_RECORDS = 16 << 10, 2 << 20, 256
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"
_SKIPPABLE, _FRAME = 0x184D2A5D, 0xFD2FB528
#: Bytes read ahead, and given to the decompressor at a time.
_READ, _SLICE = 1 << 20, 16 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive or record that isn't as it should be."""


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def encode_record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object = None, date: str = DATE) -> bytes:
    """A record of an HTTP response; a revisit, without its payload, if refers_to names the page that has it."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes], what: str) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip() or name != name.strip():
            raise WarcError(f"{what}: a line without a field: {line[:80]!r}")
        key = name.decode("utf-8", "replace").lower()
        if key in out:
            raise WarcError(f"{what}: {key} is there twice")
        out[key] = value.strip().decode("utf-8", "replace")
    return out


def _length(fields: dict[str, str], what: str) -> int:
    said = fields.get("content-length", "")
    if not (said.isascii() and said.isdigit()):
        raise WarcError(f"{what}: no valid Content-Length: {said!r}")
    return int(said)


def decode_record(data: bytes) -> dict:
    """The parts of one record; a WarcError if a header, a length or the payload's digest is wrong."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"not a record: {data[:40]!r}")
    fields = _fields(lines[1:], "record")
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise WarcError(f"record: no {name}")
    n = _length(fields, "record")
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"record: Content-Length is {n}, and {len(rest) - 4} bytes follow")
    kind = fields["warc-type"]
    out = {"record_type": kind, "url": fields.get("warc-target-uri"), "page_id": fields.get("x-page-id"), "refers_to": None, "payload": rest[:n], "payload_bytes": n}
    if kind not in ("response", "revisit"):
        return out | {"payload_digest": hashlib.sha256(rest[:n]).hexdigest()}
    http, mark, payload = rest[:n].partition(b"\r\n\r\n")
    lines = http.split(b"\r\n")
    if not mark or not lines[0].startswith(b"HTTP/"):
        raise WarcError("record: its block isn't an HTTP response")
    full = _length(_fields(lines[1:], "response"), "response")
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha256" or len(digest) != 64:
        raise WarcError("record: no SHA-256 of its payload")
    if kind == "revisit":
        if payload or not fields.get("warc-refers-to") or fields.get("warc-profile") != _PROFILE:
            raise WarcError("revisit: it has a payload, or no record or profile to refer to")
        out["refers_to"], payload = fields.get("x-refers-to-page-id"), None
    elif len(payload) != full or hashlib.sha256(payload).hexdigest() != digest:
        raise WarcError(f"response: its payload has {len(payload)} bytes instead of {full}, or another digest")
    return out | {"payload": payload, "payload_bytes": full, "payload_digest": digest}


class ArchiveWriter:
    """Writes records to one archive; the first ones are held until they can train the dictionary."""

    def __init__(self, stream):
        self.stream, self.held, self.compressor, self.size, self.records = stream, [], None, 0, 0

    def add(self, record: bytes) -> None:
        self.size += len(record)
        self.records += 1
        if self.compressor is None:
            self.held.append(record)
            if len(self.held) >= SAMPLE_RECORDS or self.size >= SAMPLE_BYTES:
                self._begin()
        else:
            self.stream.write(self.compressor.compress(record))

    def _begin(self) -> None:
        try:  # a few small records can't train one
            learned = zstandard.train_dictionary(DICTIONARY_BYTES, [x[:65536] for x in self.held], k=256, d=8)
            raw = zstandard.ZstdCompressor(level=LEVEL).compress(learned.as_bytes())
            self.stream.write(struct.pack("<II", _SKIPPABLE, len(raw)) + raw)
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=True)
        except zstandard.ZstdError:
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        for record in self.held:
            self.stream.write(self.compressor.compress(record))
        self.held = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.stream.close()


class _Input:
    """A stream read ahead in blocks, and taken from in slices."""

    def __init__(self, stream):
        self.stream, self.held, self.at = stream, b"", 0

    def have(self, n: int) -> bool:
        """Whether n bytes are left; they are held then."""
        while len(self.held) - self.at < n:
            got = self.stream.read(max(_READ, n))
            if not got:
                return False
            self.held, self.at = self.held[self.at :] + got, 0
        return True

    def left(self) -> int:
        return len(self.held) - self.at

    def take(self, n: int) -> bytes:
        self.at += n
        return self.held[self.at - n : self.at]


def frames(stream) -> Iterator[bytes]:
    """The records of an archive, one for each frame; skippable frames after the first are passed over."""
    source, decompressor, first = _Input(stream), zstandard.ZstdDecompressor(), True
    while source.have(1):
        if not source.have(8):
            raise WarcError("the archive ends within a frame")
        magic, size = struct.unpack("<II", source.held[source.at : source.at + 8])
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not source.have(8 + size):
                raise WarcError("the archive ends within a skippable frame")
            raw = source.take(8 + size)[8:]
            if first and magic == _SKIPPABLE:
                if raw[:4] == struct.pack("<I", _FRAME):
                    raw = decompressor.decompressobj().decompress(raw)
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        elif magic == _FRAME:
            out, parts = decompressor.decompressobj(), []
            try:
                while not out.eof:
                    if not source.have(1):
                        raise WarcError("the archive ends within a record")
                    parts.append(out.decompress(source.take(min(_SLICE, source.left()))))
            except zstandard.ZstdError as e:
                raise WarcError(f"a frame can't be decompressed: {e}") from e
            source.at -= len(out.unused_data)
            yield b"".join(parts)
        else:
            raise WarcError(f"no frame begins with {magic:08x}")
        first = False


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of pages to archives in folder; (path, records, bytes) of each archive.

    Of rows with equal payloads of at least LEAST_REVISIT bytes, that with the least
    id is a response and the others revisit it; rows that share the least id are all
    responses, and so is a group without an id. Null payloads are empty.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    long = rows.select("id", F.when(F.octet_length("html") >= LEAST_REVISIT, F.col("digest")).alias("digest")).where("digest is not null")
    firsts = long.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    marked = rows.join(firsts, "digest", "left").select("id", "url", "html", "digest", F.expr("case when first <> id or id is null then first end").alias("first"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        task, made, writer, path = TaskContext.get(), 0, None, None

        def done() -> pd.DataFrame:
            writer.close()
            return pd.DataFrame({"path": [path], "records": [writer.records], "bytes": [writer.size]})

        for batch in batches:
            for i, url, text, digest, first in zip(batch["id"].astype(object), batch["url"], batch["html"], batch["digest"], batch["first"].astype(object), strict=True):
                if writer is None:
                    path = f"{root}/{task.partitionId():06d}-{task.taskAttemptId()}-{made}.warc.zst"
                    made += 1
                    writer = ArchiveWriter(fs.open_output_stream(path, compression=None))
                named = lambda x: None if pd.isna(x) else int(x) if isinstance(x, float) else x
                writer.add(encode_record(named(i), url, text.encode(), digest, named(first)))
                if writer.size >= archive_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return materialize(marked.select(F.col("id").cast("string"), "url", "html", "digest", F.col("first").cast("string")).mapInPandas(write, "path string, records long, bytes long"))


def read_archives(archives: DataFrame, folder: str, *, payloads: bool = False, on_error: str = "raise") -> DataFrame:
    """Every record of the archives in the column path, on folder's file system.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload],
    error): ids as strings, payload as bytes, null for a revisit. With on_error
    "raise" a bad record or archive ends the job; with "report" it gives a row with
    an error and nothing else, and reading goes on where a next frame can be found.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * payloads + ["error"]
    kinds = {"payload_bytes": "long", "payload": "binary"}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
        rows, held = [], 0

        def out() -> pd.DataFrame:
            frame = pd.DataFrame([[r.get(k) for k in names] for r in rows], columns=names, dtype=object)
            rows.clear()
            return frame

        for batch in batches:
            for path in batch["path"]:
                with fs.open_input_stream(path, compression=None) as stream:
                    try:
                        for data in frames(stream):
                            try:
                                rows.append(decode_record(data))
                            except WarcError as e:
                                if on_error == "raise":
                                    raise WarcError(f"{path}: {e}") from e
                                rows.append({"error": str(e)})
                            held += len(data) if payloads else 1
                            if held > (16 << 20 if payloads else 10_000):
                                yield out()
                                held = 0
                    except WarcError as e:
                        if on_error == "raise":
                            raise
                        rows.append({"error": f"{path}: {e}"})
        if rows:
            yield out()

    spread = archives.select("path").repartition(max(1, archives.count()))
    return spread.mapInPandas(read, ", ".join(f"{k} {kinds.get(k, 'string')}" for k in names))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archive pages and read them back: (id, payload_bytes, payload_digest, record_type, refers_to, url).

    A row for each row of pages, repeated rows included; null ids come back as null.
    Ids are integers or strings. An empty table writes no archive and gives an empty
    result. Columns not named aren't read.
    """
    folder = f"{shared_dir(pages.sparkSession)}/warc"
    kind = pages.schema[id_col].dataType.simpleString()
    got = read_archives(write_archives(pages, folder, id_col, url_col, html_col), folder)
    return got.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("url")


SQL = """
with p as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as digest from pages),
f as (select digest, min(page_id) as first from p where n >= 100 group by digest)
select page_id, n::bigint as payload_bytes, p.digest as payload_digest,
  case when page_id <> first then 'revisit' else 'response' end as record_type,
  case when page_id <> first then first end as refers_to
from p left join f on p.digest = f.digest and n >= 100
"""
