"""Hierarchical crawls: node identifiers, paths, the resumable frontier."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import hash_text
from tessella.operators.keys import DataError, one_of_each
from tessella.sources.readers import OFFICE_SCHEMA, assert_offices, office_rows
from tessella.sources.shared import counted, exists, get_text, put_text, written

CRAWL_SCHEMA = "node_id string, parent_id string, office_name string, address string, depth int, path string, url string, is_leaf boolean, fetched boolean"


def child_path(parent: Column, name: Column) -> Column:
    return F.when(F.coalesce(parent, F.lit("")) == "", name).otherwise(F.concat(parent, F.lit(" > "), name))


def node_id(parent_id: Column, name: Column, address: Column, path: Column, is_leaf: Column) -> Column:
    """A leaf is told by its parent, name and address, an inner node by its path."""
    return F.when(is_leaf, hash_text(F.concat_ws("|", parent_id, F.upper(name), F.upper(address)), 16, "sha1")).otherwise(hash_text(F.upper(path), 16, "sha1"))


def closure(edges: DataFrame, root: str = "", separator: str = " > ") -> DataFrame:
    """(node, depth, path) of the tree of (node, parent, name), by pointer doubling.

    Every node points to an ancestor and holds the names down from it; in a round its pointer jumps to where its ancestor points, so that a chain of n nodes takes log2(n)
    rounds, each one join and one write. A node with two parents, and nodes that no root leads to (a cycle, or a missing parent), fail: a round that brings no node to its root.
    """
    sizes = edges.groupBy("node").agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.max_by("node", "n").alias("node")).first()
    if (sizes["most"] or 0) > 1:
        raise DataError(f"edges: duplicate key {sizes['node']}")
    parent = F.coalesce("parent", F.lit(""))
    top = parent == root
    pointers, total = counted(edges.select("node", F.when(~top, parent).alias("up"), F.when(top, 0).otherwise(1).alias("depth"), F.col("name").alias("path")), "pointers")
    done, left = [pointers.filter("up is null")], pointers.filter("up is not null")
    open_ = left.count()
    while open_:
        above = reduce(lambda a, b: a.union(b), [*done, left]).select(F.col("node").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"), F.col("path").alias("__path"))
        jumped = left.join(above, "up").select("node", F.col("__up").alias("up"), (F.col("depth") + F.col("__depth")).alias("depth"), F.concat("__path", F.lit(separator), "path").alias("path"))
        pointers = written(jumped, "pointers")
        still = pointers.filter("up is not null").count()
        found = pointers.count() - still
        if not found or found + still < open_:
            raise DataError(f"{open_ - found} nodes without a root above them")
        done.append(pointers.filter("up is null"))
        left, open_ = pointers.filter("up is not null"), still
    return reduce(lambda a, b: a.union(b), done).select("node", "depth", "path")


def start_crawl(spark: SparkSession, url: str, name: str = "") -> DataFrame:
    """The root: its id is the page's name in the url, without the ending, since ids of leaves contain their parent's."""
    page = url.split("?")[0].rstrip("/").rpartition("/")[2]
    return spark.createDataFrame([(page.partition(".")[0] or "root", "", name, "", 0, "", url, False, False)], CRAWL_SCHEMA)


def crawl_step(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """nodes after their pages (url, html) were read: children added once, read nodes marked. A page without a table, offices or names fails before anything changes."""
    read = nodes.filter("not is_leaf and not fetched").join(pages, "url")
    checked = read.withColumn("__offices", _offices(F.col("html"), F.col("url")))
    nameless = F.exists("__offices", lambda o: o["office_name"] == "")
    bad = checked.filter(~F.lower("html").contains("<table") | (F.size("__offices") == 0) | nameless).select("url").limit(1).collect()
    if bad:
        raise DataError(f"no office table at {bad[0][0]}")
    children = checked.select("node_id", "path", "depth", F.posexplode("__offices").alias("__place", "o"))
    path = child_path(F.col("path"), F.col("o.office_name"))
    made = children.select(
        node_id(F.col("node_id"), F.col("o.office_name"), F.col("o.address"), path, F.col("o.is_leaf")).alias("node_id"), F.col("node_id").alias("parent_id"), F.col("o.office_name").alias("office_name"),
        F.col("o.address").alias("address"), (F.col("depth") + 1).alias("depth"), path.alias("path"), F.col("o.url").alias("url"), F.col("o.is_leaf").alias("is_leaf"), F.lit(False).alias("fetched"),
        F.struct(F.col("node_id"), "__place").alias("__order"),
    )
    new = one_of_each(made, ["node_id"], "__order").drop("__order").join(nodes.select("node_id"), "node_id", "left_anti")
    done = read.select("node_id").withColumn("__done", F.lit(True))
    marked = nodes.join(done, "node_id", "left").withColumn("fetched", F.col("fetched") | F.coalesce("__done", F.lit(False))).drop("__done")
    return marked.unionByName(new.select(marked.columns))


def _offices(html: Column, url: Column) -> Column:
    @F.pandas_udf(OFFICE_SCHEMA)
    def parsed(content: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([office_rows(c, u or "") for c, u in zip(content, at)])

    return parsed(html, url)


class PageCache:
    """Pages kept in a folder of any file system, one file for each url, so that a crawl goes on after the last page fetched."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _file(self, url: str) -> str:
        return f"{self.root}/{hashlib.sha256(url.encode()).hexdigest()[:32]}.html"

    def __contains__(self, url: str) -> bool:
        return exists(self.spark, self._file(url))

    def __getitem__(self, url: str) -> str:
        return get_text(self.spark, self._file(url))

    def __setitem__(self, url: str, page: str) -> None:
        put_text(self.spark, self._file(url), page)


def crawl(nodes: DataFrame, fetch: Callable[[str], str], save: Callable[[DataFrame], DataFrame], cache: dict[str, str] | PageCache | None = None, levels: int | None = None, pause: float = 0.0) -> DataFrame:
    """Read level after level of unread inner nodes until none is left (or `levels` of them); save() stores a state and returns it read back.

    Pages are fetched by the driver, once each, `pause` seconds apart, and kept before the next is asked for; a page without a table of named offices fails and is not kept.
    """
    spark, cache = nodes.sparkSession, {} if cache is None else cache
    while levels is None or levels > 0:
        levels = levels if levels is None else levels - 1
        queue = [r["url"] for r in nodes.filter("not is_leaf and not fetched").select("url").distinct().orderBy("url").toLocalIterator()]
        if not queue:
            break
        for url in queue:
            if url in cache:
                continue
            page = fetch(url)
            assert_offices(page, url)
            cache[url] = page
            time.sleep(pause)
        # Some hundred pages at a time pass through the driver.
        for at in range(0, len(queue), 200):
            pages = spark.createDataFrame([(u, cache[u]) for u in queue[at : at + 200]], "url string, html string")
            nodes = save(crawl_step(nodes, pages))
    return nodes
