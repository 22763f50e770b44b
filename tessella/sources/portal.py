"""Pages of a portal as a data source, read by the tasks from a frontier of urls.

    spark.dataSource.register(PortalPages)
    spark.read.format("portal_pages").options(frontier=..., cache=..., pause=1).load()          # url, html
    spark.readStream.format("portal_pages").options(...).load()

The frontier is a folder of text files, one url a line; a file is one partition, so the number of files is the number of tasks that ask the portal at once, and the driver sees
file names only. As a stream its offset is the name of the last file read: later files need later names. A page is kept in the cache, a shared folder, before the next is asked
for, so neither a repeated task nor a run after a killed one asks for a page twice, unless two tasks have the same url at the same time. Each request is tried again (`tries`) and
followed by a pause (`pause` seconds). Pages without a table of named offices fail, unless `offices` is false, and are not kept. Blank lines are left out.
"""

from __future__ import annotations

import hashlib
import posixpath
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tessella.operators.tree import crawl_step
from tessella.sources.readers import assert_offices, fetch_portal
from tessella.sources.shared import open_store, qualified, shared_dir, written


@dataclass
class FrontierFile(InputPartition):
    path: str


class PortalPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "portal_pages"

    def schema(self) -> str:
        return "url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStream(dict(self.options))


class _Pages:
    def __init__(self, options: dict[str, str]):
        self.frontier, self.cache = options["frontier"].rstrip("/"), options["cache"].rstrip("/")
        self.pause, self.tries, self.timeout = float(options.get("pause", 1)), int(options.get("tries", 5)), float(options.get("timeout", 60))
        self.offices = options.get("offices", "true").lower() == "true"

    def files(self) -> list[str]:
        from pyarrow.fs import FileSelector

        store, place = open_store(self.frontier)
        found = store.get_file_info(FileSelector(place, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and f.size and not f.base_name.startswith(("_", ".")))

    def read(self, partition: FrontierFile):
        store, place = open_store(self.frontier)
        with store.open_input_stream(posixpath.join(place, partition.path), compression=None) as stream:
            urls = stream.read().decode().split("\n")
        for url in urls:
            if url.strip():
                yield url.strip(), self.page(url.strip())

    def page(self, url: str) -> str:
        from pyarrow.fs import FileType

        store, place = open_store(self.cache)
        kept = f"{place}/{hashlib.sha256(url.encode()).hexdigest()[:32]}.html"
        if store.get_file_info(kept).type == FileType.File:
            with store.open_input_stream(kept, compression=None) as stream:
                return stream.read().decode()
        page = fetch_portal(url, self.tries, self.timeout)
        if self.offices:
            assert_offices(page, url)
        beside = f"{place}/_{uuid.uuid4().hex}"
        store.create_dir(place, recursive=True)
        with store.open_output_stream(beside, compression=None) as out:
            out.write(page.encode())
        store.move(beside, kept)
        time.sleep(self.pause)
        return page


class PageReader(_Pages, DataSourceReader):
    def partitions(self) -> list[FrontierFile]:
        return [FrontierFile(f) for f in self.files()]

    def read(self, partition):
        # Without files there is still one empty task.
        return super().read(partition) if partition is not None and partition.path else iter(())


class PageStream(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max(self.files(), default="")}

    def partitions(self, start: dict, end: dict) -> list[FrontierFile]:
        return [FrontierFile(f) for f in self.files() if start["after"] < f <= end["after"]]


def crawl_pages(nodes: DataFrame, cache: str, save: Callable[[DataFrame], DataFrame], levels: int | None = None, tasks: int = 1, **options: str) -> DataFrame:
    """Read level after level of unread inner nodes until none is left (or `levels` of them), with pages fetched by `tasks` tasks; save() stores a state and returns it read back."""
    spark = nodes.sparkSession
    spark.dataSource.register(PortalPages)
    while levels is None or levels > 0:
        levels = levels if levels is None else levels - 1
        queue = nodes.filter("not is_leaf and not fetched").select("url").distinct()
        if queue.isEmpty():
            break
        frontier = f"{shared_dir(spark)}/frontier-{uuid.uuid4().hex}"
        queue.repartition(tasks).write.option("compression", "none").text(frontier)
        pages = spark.read.format("portal_pages").options(frontier=qualified(spark, frontier), cache=qualified(spark, cache), **options).load()
        nodes = save(crawl_step(nodes, written(pages, "pages")))
    return nodes
