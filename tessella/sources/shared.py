"""The folder that driver and executors share, tables written there to cut lineage, and small files through Hadoop's file systems (any store)."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessella.operators.keys import DataError


_FOLDERS: dict[str, str] = {}  # temporary folders of local sessions without the setting, by application


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a local session (tests) gets a temporary folder, and a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        set_dir, app = spark.sparkContext._jsc.sc().getCheckpointDir(), spark.sparkContext.applicationId
        if set_dir.isDefined():
            found = set_dir.get()
        elif spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            found = _FOLDERS[app] = _FOLDERS.get(app) or tempfile.mkdtemp(prefix="tessella-")
        else:
            raise DataError("spark.checkpoint.dir must name a folder that driver and executors share")
    return found.rstrip("/")


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target, fs = _path(spark, path)
        fs.delete(target, True)
    except Exception:  # the session may have ended before the interpreter does
        return


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, so that later jobs neither recompute it nor need a lost executor's files. Removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessella-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """written(df), and its number of rows, which the write itself observes."""
    seen = Observation()
    found = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return found, seen.get["rows"]


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table from driver rows as a local relation, whose size the optimizer knows."""
    columns = [pa.array([r[k] for r in rows], to_arrow_type(f.dataType)) for k, f in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it is missing."""
    target, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def qualified(spark: SparkSession, path: str) -> str:
    """The full form in which Spark gives the paths of files."""
    target, fs = _path(spark, path)
    return fs.makeQualified(target).toString()


def open_store(path: str):
    """(file system, path in it) for Python tasks, which have no Hadoop file systems at hand."""
    from urllib.parse import quote

    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/@?&=%"))


def concatenate(spark: SparkSession, folder: str, target: str, head: str = "") -> None:
    """One file of a folder's part files in the order of their names, copied through a buffer and put in place by one renaming; an existing target is an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place, fs = _path(spark, target)
    beside = f"{target}.{uuid.uuid4().hex}.tmp"
    made = _path(spark, beside)[0]
    try:
        out = fs.create(made, False)
        try:
            out.write(bytearray(head.encode("utf-8")))
            for name in sorted(n for n in children(spark, folder) if n.startswith("part-")):
                part, parts = _path(spark, f"{folder}/{name}")
                stream = parts.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
                finally:
                    stream.close()
        finally:
            out.close()
        if fs.exists(place) or not fs.rename(made, place):
            raise DataError(f"{target} is there already")
    finally:
        _remove(spark, beside)


def put_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small text file; without overwrite an existing one is an error."""
    target, fs = _path(spark, path)
    out = fs.create(target, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()
