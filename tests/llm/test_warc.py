import hashlib
import io
import struct

import pytest
import zstandard

from duelframe.llm import warc
from duelframe.llm.common import shared_dir, table


def records(n):
    return [warc.encode_record(i, f"http://a/{i}", b"<p>%d</p>" % i * (i + 1), hashlib.sha256(b"<p>%d</p>" % i * (i + 1)).hexdigest()) for i in range(n)]


def archive(recs):
    class Keep(io.BytesIO):
        def close(self):
            self.done = self.getvalue()

    out = Keep()
    w = warc.ArchiveWriter(out)
    for r in recs:
        w.add(r)
    w.close()
    return out.done


def test_frames():
    for n in (1, 3, 700):
        data = archive(records(n))
        assert list(warc.frames(io.BytesIO(data))) == records(n)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size], max_output_size=1 << 20)
    assert list(warc.frames(io.BytesIO(struct.pack("<II", magic, len(plain)) + plain + data[8 + size :]))) == records(700)
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(data[8 + size :])))  # without its dictionary
    for cut in (4, size, len(data) - 3):
        with pytest.raises(warc.WarcError):
            list(warc.frames(io.BytesIO(data[:cut])))
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(b"plain text, no frame")))
    assert list(warc.frames(io.BytesIO(b""))) == []


def test_validation():
    good = records(3)[2]
    assert warc.decode_record(good)["payload_bytes"] == 24
    for a, b in [(b"WARC/1.1", b"WARX/1.1"), (b"Content-Length: 24", b"Content-Length: 25"), (b"WARC-Date: 2000", b"WARC-Dat: 2000"), (b"<p>2", b"<p>3"), (b"sha256:", b"sha1:"), (b"WARC-Type", b"WARC-Record-ID"), (b"\r\n\r\n<p>", b"\r\n\r\n\r\n<p>"), (b"HTTP/1.1", b"GET /1.1")]:
        with pytest.raises(warc.WarcError):
            warc.decode_record(good.replace(a, b))
    revisit = warc.encode_record(7, "u", b"x" * 200, "0" * 64, 3)
    got = warc.decode_record(revisit)
    assert (got["record_type"], got["payload_bytes"], got["refers_to"], got["payload"]) == ("revisit", 200, "3", None)
    with pytest.raises(warc.WarcError):
        warc.decode_record(revisit.replace(b"WARC-Profile", b"X-Profile"))


def test_round_trip(spark):
    big, long = "é" * 60, "x<y> " * 400000
    rows = [(4, "http://a/\r\n1", big), (2, None, big), (9, "u", big), (1, "u", "s"), (3, "u", "s"), (5, "u", None), (6, "u", ""), (None, "u", big), (7, "u", long), (8, "u", long), (8, "u", long), (None, "u", "n" * 100), (None, "v", "n" * 100), (2, "u", big)]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, path int")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()), key=str)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [k for k, _, x in rows if (x or "") == (h or "") and k is not None]
        first = min(ids) if ids and len(b) >= 100 else i
        again = i != first
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payloads_and_reports(spark, tmp_path):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    folder = f"{shared_dir(spark)}/w"
    made = warc.write_archives(pages, folder, archive_bytes=20000)
    assert made.count() > 1
    got = {int(r.page_id): r.payload for r in warc.read_archives(made, folder, payloads=True).where("record_type = 'response'").collect()}
    want = {r.page_id: r.html for r in pages.collect()}
    assert {k: v.decode() for k, v in got.items()} == {k: want[k] for k in got}
    bad = tmp_path / "bad.warc.zst"
    bad.write_bytes(archive([*records(2), b"junk", *records(1)]))
    paths = spark.createDataFrame([(str(bad),)], "path string")
    rows = warc.read_archives(paths, str(tmp_path), on_error="report").collect()
    assert [r.error is None for r in rows] == [True, True, False, True]
    with pytest.raises(Exception, match="not a record"):
        warc.read_archives(paths, str(tmp_path)).collect()
