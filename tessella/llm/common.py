"""Helpers shared by the corpus operators: reading tables, names that clash with no column, numbers of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.shared import local_table, written as materialise

__all__ = ["crc_mod", "local_table", "materialise", "partitions_of", "read_table", "small_batches", "unused"]

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory, read by Spark alone (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """name, with underscores in front until no column of df has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def partitions_of(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, modulus: int):
    """crc32 of a column's text form, modulo modulus (null: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about 4 MB where the session keeps Spark's default of 64 MB: the JVM and the Python worker hold a batch of texts several times each."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(4 << 20))
