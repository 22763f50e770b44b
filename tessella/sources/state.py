"""State as a log: bases and deltas in folders of their own, versions that name their folders, one writer a version."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.keys import DataError
from tessella.sources.shared import _remove, children, counted, get_text, put_text

COMPACT = 8  # deltas of a table after which its next write is a base again


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns])


def rows_not_in(rows: DataFrame, others: DataFrame, columns: list[str]) -> DataFrame:
    """rows without an equal among others by these columns, nulls being equal."""
    return rows.alias("x").join(others.alias("y"), _same("x", "y", columns), "left_anti")


class VersionedState:
    """Tables as versions in a folder of any file system; a version counts once its mark is there, and the latest one is the state.

    Every write goes to a folder of its own, which the mark names, so that two writers never share a file. A mark is made in one step and never replaced: a writer that has
    read version N can only make version N + 1, and of two such writers the second fails, removes its folder and changes nothing. A table that is saved with a key writes only
    what differs from the version read: changed and new rows, and the keys of rows that went. After COMPACT such deltas the next one is a base.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.read: int | None = None  # the version that was loaded, or saved, last

    def _mark(self, version: int) -> str:
        return f"{self.root}/done={version}.mark"

    def version(self) -> int:
        """The latest complete version, 0 without any. A mark that is not written to its end doesn't count."""
        found = sorted((int(n[5:-5]) for n in children(self.spark, self.root) if re.fullmatch("done=[0-9]+[.]mark", n)), reverse=True)
        return next((v for v in found if self._parts(v) is not None), 0)

    def _parts(self, version: int) -> dict[str, list[dict]] | None:
        try:
            return json.loads(get_text(self.spark, self._mark(version)))
        except json.JSONDecodeError:
            return None

    def load(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of the latest version, or of an earlier one."""
        version = version or self.version()
        if not version:
            raise DataError(f"no state in {self.root}")
        self.read = version
        return {name: self._table(parts) for name, parts in self._parts(version).items()}

    def _table(self, parts: list[dict]) -> DataFrame:
        base, *deltas = parts
        rows = self.spark.read.parquet(f"{self.root}/{base['folder']}")
        if not deltas:
            return rows
        key = deltas[-1]["key"]
        read = [self.spark.read.parquet(f"{self.root}/{d['folder']}").withColumn("__at", F.lit(k)) for k, d in enumerate(deltas)]
        latest = reduce(lambda a, b: a.unionByName(b), read).groupBy(*key).agg(F.max_by(F.struct(*rows.columns, "__gone"), "__at").alias("__row")).select("__row.*")
        # The base is not shuffled where the deltas are small.
        return rows_not_in(rows, latest.select(key), key).unionByName(latest.filter("not __gone").select(rows.columns))

    def save(self, tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> int:
        """Write the version after the one read (without one, after the latest): deltas for tables with a key, bases for the others."""
        before = self.version() if self.read is None else self.read
        old, folder = (self._parts(before) if before else {}) or {}, f"v={before + 1}-{uuid.uuid4().hex}"
        try:
            made = {name: self._write(rows, f"{folder}/{name}", old.get(name, []), (keys or {}).get(name)) for name, rows in tables.items()}
            try:
                put_text(self.spark, self._mark(before + 1), json.dumps(made), overwrite=False)
            except Exception as error:
                raise DataError(f"version {before + 1} was saved by another writer") from error
        except Exception:
            _remove(self.spark, f"{self.root}/{folder}")
            raise
        self.read = before + 1
        return before + 1

    def _write(self, rows: DataFrame, folder: str, old: list[dict], key: list[str] | None) -> list[dict]:
        target = f"{self.root}/{folder}"
        if key and old and len(old) <= COMPACT:
            was = self._table(old)
            if was.schema.simpleString() == rows.schema.simpleString():
                twice = rows.groupBy(*key).count().filter("count > 1").limit(1).collect()
                if twice:
                    raise DataError(f"duplicate key {twice[0][:-1]}")
                changed = rows_not_in(rows, was, rows.columns).withColumn("__gone", F.lit(False))
                gone = rows_not_in(was, rows.select(key), key).withColumn("__gone", F.lit(True))
                delta, n = counted(changed.unionByName(gone), "delta")
                if not n:
                    return old
                delta.write.parquet(target)
                return [*old, {"folder": folder, "key": key, "rows": n}]
        rows.write.parquet(target)
        return [{"folder": folder}]
