"""Keys, references and equality of tables, as aggregates and joins that return the violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


REPEATED = 65_536  # copies of a row that are put out from one array


class DataError(ValueError):
    """A table breaks a rule; the message names the first offending value."""


def key_violations(rows: DataFrame, key: str) -> DataFrame:
    """(value, rows, reason) of blank and repeated keys."""
    value = F.coalesce(F.col(key).cast("string"), F.lit(""))
    counted = rows.groupBy(value.alias("value")).agg(F.count("*").alias("rows"))
    reason = F.when(F.col("value") == "", "blank").when(F.col("rows") > 1, "duplicate")
    return counted.withColumn("reason", reason).filter("reason is not null")


def assert_empty(violations: DataFrame, what: str) -> None:
    """Raise with the first violation; only one row is fetched."""
    first = violations.limit(1).collect()
    if first:
        raise DataError(f"{what}: {first[0].asDict()}")


def assert_key(rows: DataFrame, key: str, name: str = "table") -> DataFrame:
    """rows, after checking that key exists, is never blank and never repeats."""
    if key not in rows.columns:
        raise DataError(f"{name}: missing column {key}")
    assert_empty(key_violations(rows, key), f"{name}: duplicate key or blank {key}")
    return rows


def occurrence(key: list[Column | str], order: list[Column | str]) -> Column:
    """Which of the rows with one key this is, from 1."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order))


def next_sequence(issued: DataFrame, codes: DataFrame, id_column: str = "application_id", code_column: str = "code") -> DataFrame:
    """The number after the largest issued one, for each code (1 where none is issued)."""
    parts = issued.select(F.regexp_extract(id_column, r"^(.*)-([0-9]+)$", 1).alias(code_column), F.regexp_extract(id_column, r"^(.*)-([0-9]+)$", 2).alias("number"))
    largest = parts.filter("number != ''").groupBy(code_column).agg(F.max(F.col("number").cast("long")).alias("largest"))
    return codes.join(largest, code_column, "left").select(code_column, (F.coalesce("largest", F.lit(0)) + 1).alias("next_number"))


def orphans(rows: DataFrame, parents: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Rows whose reference has no parent."""
    return rows.join(parents.select(F.col(parent_column).alias("__parent")), F.col(column) == F.col("__parent"), "left_anti")


def mandatory_lookup(rows: DataFrame, parents: DataFrame, on: str, name: str) -> DataFrame:
    """Inner join that fails on the first row without a match."""
    assert_empty(rows.join(parents.select(on), on, "left_anti").select(on).orderBy(on), f"{name}: no match")
    return rows.join(parents, on)


def lookup_keep_last(rows: DataFrame, right: DataFrame, on: list[str], order: str) -> DataFrame:
    """Left join with at most one right row for each key: the last one in order."""
    return rows.join(one_of_each(right, on, order, last=True).drop(order), on, "left")


def one_of_each(rows: DataFrame, by: list[str], order: str, last: bool = False) -> DataFrame:
    """The first (or last) row in order of every group: an aggregate, which combines before the shuffle."""
    rest = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in by])
    pick = (F.max_by if last else F.min_by)(rest, order)
    return rows.groupBy(*by).agg(pick.alias("__row")).select(*[F.col(f"`{c}`") if c in by else F.col(f"__row.`{c}`").alias(c) for c in rows.columns])


def one_to_one(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str) -> DataFrame:
    """Join the k-th row of a key with the k-th row of that key; both sides must match in full."""
    a = left.withColumn("__k", occurrence([key], [left_order]))
    b = right.withColumn("__k", occurrence([key], [right_order]))
    on = [key, "__k"]
    assert_empty(a.select(*on).join(b.select(*on), on, "left_anti").union(b.select(*on).join(a.select(*on), on, "left_anti")), "not one to one")
    return a.join(b, on).withColumnRenamed("__k", "occurrence")


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often, with the side, as often as it has them more; empty when the tables are equal. One shuffle of row counts."""
    columns = [F.col(f"`{c}`") for c in left.columns]
    both = left.select(*columns, F.lit(1).alias("__n")).union(right.select(*columns, F.lit(-1).alias("__n")))
    counts = both.groupBy(*columns).agg(F.sum("__n").alias("__n")).filter("__n != 0")
    blocks = counts.select(*columns, "__n", F.explode(F.sequence(F.lit(0), F.floor((F.abs("__n") - 1) / REPEATED))).alias("__block"))
    copies = blocks.select(*columns, "__n", F.explode(F.sequence(F.lit(1), F.least(F.abs("__n") - F.col("__block") * REPEATED, F.lit(REPEATED)))))
    return copies.select(*columns, F.when(F.col("__n") > 0, "left").otherwise("right").alias("side"))


def assert_same_rows(left: DataFrame, right: DataFrame, what: str) -> None:
    """Raise unless both sides hold the same rows of the same columns."""
    if set(left.columns) != set(right.columns):
        raise DataError(f"{what} differs in its columns: {sorted(set(left.columns) ^ set(right.columns))}")
    assert_empty(differing_rows(left, right), f"{what} differs")
