"""Crawls and streams that are cut off and go on: what the server was asked is counted."""

import json
import os
import signal
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from duelframe.__main__ import main
from duelframe.sources import crawl, files, rest, web

LINK = '<a href="/videos/battle/e{0}"><div class="ft-article"><h4>E{0}</h4></div></a>'
MATCH = "<div class='row my-4'><div class='col-md-5 my-3'><div class='youtube-player' data-id='i{0}'></div></div><div class='col-md-7 my-3'><h4>A vs B{0}</h4></div></div>"


class Site(BaseHTTPRequestHandler):
    asked, at, broken, ids = Counter(), [], set(), []

    def do_GET(self):
        url = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        Site.asked[url.path] += 1
        Site.at.append(time.monotonic())
        if url.path in Site.broken:
            return self.send_error(500)
        if url.path == "/videos/battle":
            text = "".join(LINK.format(k) for k in range(int(q["year"]) % 10 * 4, int(q["year"]) % 10 * 4 + 8))  # years overlap
        elif url.path == "/channels":
            text = json.dumps({"items": [{"contentDetails": {"relatedPlaylists": {"uploads": "UP"}}}]})
        elif url.path == "/playlistItems":
            at = int(q.get("pageToken", 0))
            text = json.dumps({"items": [{"contentDetails": {"videoId": v}} for v in Site.ids[at : at + 50]]} | ({"nextPageToken": str(at + 50)} if at + 50 < len(Site.ids) else {}))
        elif url.path == "/videos":
            text = json.dumps({"items": [{"id": v, "snippet": {"title": v}} for v in q["id"].split(",")]})
        else:
            text = MATCH.format(url.path.rsplit("e", 1)[-1])
        self.send_response(200)
        self.end_headers()
        self.wfile.write(text.encode())

    def log_message(self, *a):
        pass


@pytest.fixture()
def site():
    Site.asked, Site.at, Site.broken = Counter(), [], set()
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_a_killed_worker_costs_no_second_request(spark, site, tmp_path):
    """The worker dies after seven pages; the next run asks for the rest alone."""
    urls = spark.createDataFrame([(f"{site}/e{k}",) for k in range(20)] + [(f"{site}/e3",), (None,)], "url string")
    folder, dead, get = str(tmp_path / "crawl"), str(tmp_path / "dead"), crawl.get_page
    held = []

    def dying(url):
        held.append(url)
        if len(held) > 7 and not os.path.exists(dead):
            open(dead, "w").close()
            os.kill(os.getpid(), signal.SIGKILL)
        return get(url)

    with pytest.raises(Exception):
        crawl.crawl(urls, folder, sleep=0, fetch=dying)
    states = {r.state: r["count"] for r in crawl.frontier(urls, folder).groupBy("state").count().collect()}
    assert states == {"done": 7, "todo": 13} and sum(Site.asked.values()) == 7
    got = crawl.crawl(urls, folder, sleep=0, fetch=dying)
    assert got.count() == 20 and got.where("html is null or error is not null").count() == 0
    assert len(Site.asked) == 20 and set(Site.asked.values()) == {1}
    crawl.crawl(urls, folder, sleep=0)
    assert sum(Site.asked.values()) == 20


def test_failures_are_kept_and_tried_by_the_next_run(spark, site, tmp_path):
    urls = spark.createDataFrame([(f"{site}/e{k}",) for k in range(4)], "url string")
    Site.broken = {"/e2"}
    got = {r.url[-2:]: r for r in crawl.crawl(urls, str(tmp_path), sleep=0, retries=1, request_sleep=0).collect()}
    assert "500" in got["e2"].error and got["e2"].html is None and Site.asked["/e2"] == 2
    assert {(r.url[-2:], r.state, r.tries) for r in crawl.frontier(urls, str(tmp_path)).collect()} == {("e0", "done", 1), ("e1", "done", 1), ("e2", "failed", 1), ("e3", "done", 1)}
    Site.broken = set()
    assert crawl.crawl(urls, str(tmp_path), sleep=0).where("error is not null").count() == 0
    assert {(r.state, r.tries) for r in crawl.frontier(urls.where("url like '%e2'"), str(tmp_path)).collect()} == {("done", 2)} and Site.asked["/e0"] == 1
    assert crawl.crawl(urls.limit(0), str(tmp_path), sleep=0).count() == 0 and crawl.shelved(spark, f"{tmp_path}/none").count() == 0


def test_one_pace_for_a_host(spark, site, tmp_path):
    urls = spark.createDataFrame([(f"{site}/e{k}",) for k in range(6)], "url string")
    for tasks in (1, 3):
        Site.at = []
        crawl.crawl(urls, f"{tmp_path}/{tasks}", sleep=0.3, tasks=tasks)
        assert len(Site.at) == 6 and max(Site.at) - min(Site.at) >= (1.4 if tasks == 1 else 0.8)


def test_years_share_pages_and_a_second_run_fetches_nothing(spark, site, tmp_path, capsys):
    rows, failed = web.scrape_years(spark, 2020, 2021, site, folder=str(tmp_path / "c"), sleep=0)
    assert rows.count() == 16 and rows.select("video_id").distinct().count() == 12 and failed.count() == 0
    assert Site.asked["/videos/battle"] == 2 and sum(Site.asked.values()) == 14
    args = ["events", "--start", "2020", "--end", "2021", "--base", site, "--sleep", "0", "--output", str(tmp_path / "e.csv"), "--folder", str(tmp_path / "c")]
    assert main(args, spark) == 0 and sum(Site.asked.values()) == 14
    assert "16 matchups" in capsys.readouterr().out and len((tmp_path / "e.csv").read_text().splitlines()) == 17


def test_a_stream_reads_down_to_the_newest_id_it_has_seen(spark, site, tmp_path, monkeypatch):
    monkeypatch.delenv("YOUTUBE_API_KEY", raising=False)
    secret = tmp_path / "secret.json"
    secret.write_text('{"YT_API_KEY": "k"}')
    path, state = f"{tmp_path}/up", f"{tmp_path}/state"

    def run():
        Site.asked = Counter()
        rest.stream_channel_uploads(spark, "ch", path, state, site, str(secret), pace=0).awaitTermination()
        return Site.asked["/playlistItems"], Site.asked["/videos"]

    Site.ids = [f"v{k}" for k in range(120, 0, -1)]
    pages, videos = run()
    assert files.load_existing(spark, path).count() == 120 and pages == 4 and videos >= 3  # one to see what is new, three to read
    assert run() == (1, 0)
    Site.ids = ["v123", "v122", "v121", *Site.ids]
    assert run()[0] == 2 and files.load_existing(spark, path).count() == 123  # of four pages one is read
    Site.ids = ["v124", *Site.ids[1:]]  # the newest one seen is gone: all pages are read, and only what is new is added
    assert run()[0] == 4 and files.load_existing(spark, path).count() == 124 and run() == (1, 0)


def test_counts_are_observed_while_writing(spark, tmp_path, capsys, monkeypatch):
    ups = [{"id": str(k), "title": f"Top - A{k} vs B", "upload_date": "2019-01-01T00:00:00Z", "duration": "PT1S", "url": "u"} for k in range(5)]
    (tmp_path / "youtube_videos.json").write_text(json.dumps(ups))
    (tmp_path / "matchup_events_metadata.csv").write_text("matchup,event_name,event_description,video_id\nm,E,At: X. Jan 1 2019,0\nm,E,\"At: X. Jan 1, 2019\",1\n")
    args = ["battles", "--raw", str(tmp_path), "--output", f"{tmp_path}/b.csv", "--league", "Top"]
    assert main(args, spark) == 0 and "5 battles" in (said := capsys.readouterr().out) and "4 without a date" in said
    assert len((tmp_path / "b.csv").read_text().splitlines()) == 6
