"""Readers and writers. Every value is text; a blank is the empty string."""

from __future__ import annotations

import csv
import hashlib
import html.parser
import io
import os
import re
import uuid
from urllib.parse import unquote, urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions.text import OPTION, SELECT, match_key, normalize_text
from tessella.operators.keys import DataError, assert_empty
from tessella.sources.shared import _remove, concatenate, local_table, open_store, qualified
from tessella.sources.state import VersionedState  # noqa: F401  where it was before


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV file with every column text; the literal NA is text, blanks are empty strings. Columns come from the header unless given."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False)
    reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    rows = reader.csv(path)
    # Spaces and tabs around a value are no part of it, inside quotes as well.
    return rows.select([F.coalesce(F.regexp_replace(F.col(f"`{c}`"), r"^[ \t]+|[ \t]+$", ""), F.lit("")).alias(c) for c in rows.columns])


def write_csv_text(rows: DataFrame, path: str) -> None:
    """A folder of CSV files with a header, blanks for nulls."""
    rows.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]).write.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_csv_file(rows: DataFrame, path: str, order: list[str]) -> None:
    """One CSV file with a header: rows in the order of the given columns, then of all others, so the same rows make the same bytes at any partitioning.

    Ranges are sorted and written by the tasks; the parts are joined through a buffer and renamed in one step. An existing file is an error.
    """
    spark = rows.sparkSession
    texts = rows.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in rows.columns])
    places = [f"`{c}`" for c in [*order, *[c for c in rows.columns if c not in order]]]
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(rows.columns)
    parts = f"{path}.{uuid.uuid4().hex}.parts"
    try:
        texts.orderBy(*places).write.option("header", False).option("emptyValue", "").option("escape", '"').option("compression", "none").csv(parts)
        concatenate(spark, parts, path, head.getvalue())
    finally:
        _remove(spark, parts)


def file_digests(spark: SparkSession, path: str, glob: str = "*", whole: int = 256 << 20) -> DataFrame:
    """(path, sha256) of the files below a folder, hashed where they are read: files of at most `whole` bytes as values, larger ones of any size by a stream of blocks. Scans leave empty files out; they come from the scan's own listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)

    def streamed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([stream_digest(p) for p in batch.column(0).to_pylist()], pa.string())], ["path", "sha256"])

    small = files.filter(F.col("length") <= whole).select("path", F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > whole).select("path").mapInArrow(streamed, "path string, sha256 string")
    listed = local_table(spark, [(unquote(p).replace("file:///", "file:/", 1),) for p in files.inputFiles()], T.StructType([T.StructField("path", T.StringType())]))
    empty = listed.join(files.select("path"), "path", "left_anti").select("path", F.sha2(F.lit(b""), 256).alias("sha256"))
    return small.union(large).union(empty)


def stream_digest(path: str, block: int = 4 << 20) -> str:
    """SHA-256 of a file, a block in memory at a time."""
    store, name = open_store(path)
    found = hashlib.sha256()
    with store.open_input_stream(name) as stream:
        while data := stream.read(block):
            found.update(data)
    return found.hexdigest()


def relative_digests(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """file_digests with paths relative to root."""
    base = qualified(spark, root).rstrip("/")
    return file_digests(spark, root, glob).withColumn("path", F.expr(f"substring(path, {len(base) + 2})"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of sources: a CSV with at least path and sha256."""
    rows = read_csv_text(spark, path)
    if not {"path", "sha256"} <= set(rows.columns):
        raise DataError("a manifest has path and sha256")
    return rows


def tracked_files(root: str) -> list[str]:
    """Paths under version control or about to be, from the driver."""
    import subprocess

    return subprocess.run(["git", "-C", root, "ls-files", "-z", "--cached", "--others", "--exclude-standard"], capture_output=True, text=True, check=True).stdout.split("\0")[:-1]


def file_texts(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """(path, text, sha256) of listed files, read by the tasks."""
    base = os.path.abspath(root)
    files = spark.read.format("binaryFile").load([os.path.join(base, p) for p in paths])
    return files.select(F.expr(f"substring(path, locate('{base}/', path) + {len(base) + 1})").alias("path"), F.decode("content", "UTF-8").alias("text"), F.sha2("content", 256).alias("sha256"))


def verify_manifest(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, problem) of files that a manifest of (path, sha256) names and that are missing or changed."""
    joined = manifest.select("path", F.col("sha256").alias("expected")).join(actual, "path", "left")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") != F.col("expected"), "changed")
    return joined.select("path", problem.alias("problem")).filter("problem is not null")


def assert_sources(actual: DataFrame, manifest: DataFrame) -> None:
    assert_empty(verify_manifest(actual, manifest).orderBy("path"), "source differs from its manifest")


PAGE_NAME = r"^page_[0-9]+\.json$"


def read_json_names(spark: SparkSession, path: str) -> DataFrame:
    """Distinct squeezed names of the JSON pages of a folder (files page_<number>.json); a folder without pages fails."""
    pages = spark.read.option("pathGlobFilter", "page_*.json").text(path, wholetext=True).filter(F.col("_metadata.file_name").rlike(PAGE_NAME))
    if pages.limit(1).count() == 0:
        raise DataError(f"no pages in {path}")
    return json_names(pages.select(F.col("value").alias("json")))


def json_names(pages: DataFrame, page: str = "json") -> DataFrame:
    """Distinct squeezed names of JSON pages (arrays of strings); raw control characters, which JSON forbids, count as spaces."""
    repaired = F.regexp_replace(page, r"\p{Cntrl}", " ")
    names = pages.select(F.explode(F.from_json(repaired, "array<string>")).alias("name"))
    return names.select(normalize_text("name").alias("office_name")).distinct()


def select_options(page: Column, name: str = "MinistryId") -> Column:
    """array<struct<value, label>> of the options of a page's named select; entities stay as they are. Null without the select."""
    inside = F.regexp_extract(page, SELECT.replace("{name}", name), 1)
    values, labels = (F.regexp_extract_all(inside, F.lit(OPTION), F.lit(k)) for k in (1, 2))
    pairs = F.zip_with(values, labels, lambda v, t: F.struct(normalize_text(v).alias("value"), normalize_text(F.regexp_replace(t, "<[^>]+>", " ")).alias("label")))
    found = F.filter(pairs, lambda o: (o["value"] != "") & (o["label"] != "") & ~o["label"].contains("--Select--"))
    return F.when(page.rlike(SELECT.replace("{name}", name)), found)


def portal_options(pages: DataFrame, page: str = "html") -> DataFrame:
    """(office_name, portal_value_id) of the pages' options; of names equal but for case and signs the first in byte order stays, of equal names the first of a page."""
    found = pages.withColumn("__o", select_options(F.col(page)))
    assert_empty(found.filter("__o is null").select(F.lit(page).alias("page")), "select not found")
    options = found.select(F.posexplode("__o").alias("place", "o")).select("place", F.col("o.label").alias("office_name"), F.col("o.value").alias("portal_value_id"))
    first = options.groupBy(match_key("office_name").alias("key")).agg(F.min(F.struct("office_name", "place", "portal_value_id")).alias("o"))
    return first.select("o.office_name", "o.portal_value_id")


def portal_rows(pages: DataFrame, page: str = "html") -> DataFrame:
    """Distinct office names in the second cells of the pages' tables."""

    @F.pandas_udf("array<string>")
    def cells(content: pd.Series) -> pd.Series:
        return pd.Series([second_cells(c) for c in content])

    return pages.select(F.explode(cells(F.col(page))).alias("office_name")).filter("office_name != ''").distinct()


class _Cell:
    """One cell: kind, text, text of the primary block, text of the block after it, links."""

    def __init__(self, kind: str):
        self.kind, self.text, self.links = kind, "", []
        self.parts: dict[str, str] = {}
        self.block, self.depth = "", 0  # the block whose text is read, and the open div elements in it

    def open_div(self, classes: list[str]) -> None:
        if self.block:
            self.depth += 1
            return
        name = "primary" if "primary" not in self.parts and "text-primary" in classes else "address" if "primary" in self.parts and "address" not in self.parts else ""
        if name:
            self.parts[name] = ""
            self.block, self.depth = name, 1

    def close_div(self) -> None:
        if self.block:
            self.depth -= 1
            if not self.depth:
                self.block = ""

    def add(self, text: str) -> None:
        self.text += text
        if self.block:
            self.parts[self.block] += text


class _Rows(html.parser.HTMLParser):
    """Table rows as lists of cells, in order of their start. Tables may stand in cells: what an inner table holds counts for the outer cell as well."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[_Cell]] = []
        self.tables: list[list] = [[None, None]]  # open tables: the open row and cell of each

    def _cells(self) -> list[_Cell]:
        return [cell for _, cell in self.tables if cell is not None]

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        table = self.tables[-1]
        if tag == "table":
            self.tables.append([None, None])
        elif tag == "tr":
            table[:] = [[], None]
            self.rows.append(table[0])
        elif tag in ("td", "th") and table[0] is not None:
            table[1] = _Cell(tag)
            table[0].append(table[1])
        elif tag == "div":
            for cell in self._cells():
                cell.open_div((given.get("class") or "").split())
        elif tag == "a" and given.get("href"):
            for cell in self._cells():
                cell.links.append(given["href"])

    def handle_endtag(self, tag):
        table = self.tables[-1]
        if tag == "table" and len(self.tables) > 1:
            self.tables.pop()
        elif tag == "tr":
            table[:] = [None, None]
        elif tag in ("td", "th"):
            table[1] = None
        elif tag == "div":
            for cell in self._cells():
                cell.close_div()

    def handle_data(self, data):
        for cell in self._cells():
            cell.add(data)


def table_rows(page: str | None) -> list[list[_Cell]]:
    """Rows of a page's tables."""
    parser = _Rows()
    parser.feed(page or "")
    parser.close()
    return parser.rows


def second_cells(page: str | None) -> list[str]:
    """Second cells of rows with two cells or more, the heading row left out."""
    return [" ".join(r[1].text.split()) for r in [r for r in table_rows(page) if len(r) > 1][1:]]


def office_rows(page: str | None, page_url: str) -> list[dict]:
    """Offices of a portal page: rows of three cells or more whose first is a number. A row whose last cell links to sub-offices is no leaf."""
    out = []
    for row in table_rows(page):
        cells = [c for c in row if c.kind == "td"]
        if len(cells) < 3 or not re.fullmatch("[0-9]+", " ".join(cells[0].text.split())):
            continue
        office = cells[1]
        name, address = office.parts.get("primary", office.text), office.parts.get("address", "")
        link = next((h for h in cells[-1].links if "show_sub_office" in h), None)
        out.append({"office_name": " ".join(name.split()), "address": " ".join(address.split()), "url": urljoin(page_url, link) if link else "", "is_leaf": link is None})
    return out


def assert_offices(page: str, url: str) -> None:
    """Raise unless a page has a table of named offices."""
    offices = office_rows(page, url)
    if "<table" not in page.lower() or not offices or not all(o["office_name"] for o in offices):
        raise DataError(f"no office table at {url}")


OFFICE_SCHEMA = "array<struct<office_name:string,address:string,url:string,is_leaf:boolean>>"


def parse_office_pages(pages: DataFrame, page: str = "html", url: str = "url") -> DataFrame:
    """pages exploded to one row for each office; pages are parsed in Arrow batches."""
    @F.pandas_udf(OFFICE_SCHEMA)
    def parsed(content: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([office_rows(c, u or "") for c, u in zip(content, at)])

    return pages.withColumn("__office", F.explode(parsed(F.col(page), F.col(url)))).select(*[c for c in pages.columns if c != page], F.col("__office.office_name"), F.col("__office.address"), F.col("__office.url").alias("office_url"), F.col("__office.is_leaf"))


def register_office_rows(spark: SparkSession, name: str = "office_rows") -> None:
    """A table function for SQL: FROM pages, LATERAL office_rows(html, url). A page without offices has no row."""

    @F.udtf(returnType="office_name string, address string, office_url string, is_leaf boolean", useArrow=True)
    class OfficeRows:
        def eval(self, content: str, at: str):
            for office in office_rows(content, at or ""):
                yield office["office_name"], office["address"], office["url"], office["is_leaf"]

    spark.udtf.register(name, OfficeRows)


def fetch_portal(url: str, tries: int = 5, timeout: float = 60.0, agent: str = "tessella/1") -> str:
    """A page over HTTP with a time limit and retries; crawls take any function of this form."""
    import time
    import urllib.request

    for attempt in range(tries):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as reply:
                return reply.read().decode(reply.headers.get_content_charset() or "utf-8", "replace")
        except OSError:
            if attempt + 1 == tries:
                raise
            time.sleep(2**attempt)
    raise DataError(url)


def read_yaml(path: str) -> dict:
    import yaml

    with open(path) as file:
        return yaml.safe_load(file)
