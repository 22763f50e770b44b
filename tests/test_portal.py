"""Pages of a portal on this machine, as a batch source, a stream and a crawl."""

import os
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tessella import commands
from tessella.operators import tree
from tessella.sources.portal import PortalPages, crawl_pages
from tessella.sources.shared import written


@pytest.fixture
def portal():
    """(address, counts of requests, paths that fail). /n has sub-offices n1 to n3 until the third level."""
    seen, failing = Counter(), set()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen[self.path] += 1
            name = self.path.rpartition("/")[2]
            link = (lambda k: "") if len(name) > 2 else (lambda k: f'<a href="/show_sub_office/{name}{k}">more</a>')
            rows = "".join(f"<tr><td>{k}</td><td>Office {name}{k}</td><td>{link(k)}</td></tr>" for k in (1, 2, 3))
            body = b"<p>busy" if self.path in failing else f"<table>{rows}</table>".encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen, failing
    server.shutdown()


def test_crawl_goes_on_without_asking_twice(spark, portal, tmp_path):
    address, seen, failing = portal
    start = tree.start_crawl(spark, f"{address}/show_sub_office/n", "Root")
    failing.add("/show_sub_office/n2")
    with pytest.raises(Exception, match="no office table"):
        crawl_pages(start, str(tmp_path / "cache"), lambda n: written(n, "nodes"), tasks=1, pause="0")
    failing.clear()
    before = Counter(seen)
    nodes = crawl_pages(start, str(tmp_path / "cache"), lambda n: written(n, "nodes"), tasks=3, pause="0")
    assert nodes.count() == 1 + 3 + 9 + 27 and nodes.filter("is_leaf").count() == 27
    assert {p: c for p, c in seen.items() if p != "/show_sub_office/n2"} == dict.fromkeys((p for p in seen if p != "/show_sub_office/n2"), 1)
    assert before["/show_sub_office/n"] == 1 and not [f for f in os.listdir(tmp_path / "cache") if f.startswith("_")]
    again = Counter(seen)
    one = tree.crawl(start, lambda u: 1 / 0, lambda n: written(n, "nodes"), tree.PageCache(spark, str(tmp_path / "cache")))
    assert seen == again and sorted(map(tuple, one.collect())) == sorted(map(tuple, nodes.select(one.columns).collect()))


def test_collect_command_reads_by_tasks(spark, portal, tmp_path):
    address, seen, _ = portal
    for _ in range(2):
        assert commands.collect(spark, f"{address}/show_sub_office/n11", str(tmp_path / "s"), pause=0) == 4
    assert seen == {"/show_sub_office/n11": 1}


def test_frontier_as_a_stream_goes_on_after_its_offset(spark, portal, tmp_path):
    address, seen, _ = portal
    spark.dataSource.register(PortalPages)
    (tmp_path / "frontier").mkdir()
    options = {"frontier": str(tmp_path / "frontier"), "cache": str(tmp_path / "cache"), "pause": "0"}

    def run():
        pages = spark.readStream.format("portal_pages").options(**options).load()
        stream = pages.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "pages"))
        try:
            stream.processAllAvailable()
        finally:
            stream.stop()
        return sorted(r["url"].rpartition("/")[2] for r in spark.read.parquet(str(tmp_path / "pages")).collect())

    (tmp_path / "frontier" / "0001").write_text(f"{address}/a\n\n{address}/b\n")
    assert run() == ["a", "b"]
    (tmp_path / "frontier" / "0002").write_text(f"{address}/c")
    assert run() == ["a", "b", "c"]
    assert set(seen.values()) == {1}
    empty = spark.read.format("portal_pages").options(**{**options, "frontier": str(tmp_path / "none")}).load()
    assert empty.count() == 0
