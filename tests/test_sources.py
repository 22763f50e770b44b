"""Sinks, single files, digests of large files, table functions, apportionment of many groups."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import allocate, keys, letters
from tessella.operators.keys import DataError
from tessella.sources import readers
from tessella.sources.textfiles import TextFiles


@pytest.mark.parametrize("seed", range(3))
def test_many_groups_equal_the_driver_form(spark, monkeypatch, seed):
    rng = random.Random(seed)
    groups = [(f"g{k}", rng.choice([0, 1, 1, 2, 7, 50]), rng.randint(0, 9), 0) for k in range(300)]
    groups = [(g, w, cap, rng.randint(0, min(cap, 1))) for g, w, cap, _ in groups]
    reach = sum(cap if w else lo for _, w, cap, lo in groups)
    rows = spark.createDataFrame(groups, "g string, w long, cap long, lo long").repartition(5)
    for total in (sum(g[3] for g in groups), reach // 2, reach - 1, reach):
        wanted = allocate.apportion({g: w for g, w, _, _ in groups}, total, {g: c for g, _, c, _ in groups}, {g: lo for g, _, _, lo in groups})
        monkeypatch.setattr(allocate, "DRIVER_GROUPS", 10)
        assert {r["g"]: r["allocated"] for r in allocate.apportion_table(rows, total, "g", "w", "cap", "lo").collect()} == wanted


def test_many_groups_need_no_single_task(spark):
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("g"), F.lit(1).alias("w"))
    done = allocate.apportion_once(rows, 50_000, "g", "w")
    assert done.agg(F.sum("allocated")).first()[0] == 50_000
    first = {str(k) for k in sorted(map(str, range(200_000)))[:50_000]}
    assert {r["g"] for r in done.filter("allocated = 1").collect()} == first
    assert "SinglePartition" not in done._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]


def test_differing_rows_counts_copies(spark):
    left = spark.createDataFrame([("a", 1)] * 3 + [("b", None)] * 2, "`x.y` string, n int")
    right = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b"), (None, "b"), (2, "c")], "n int, `x.y` string")
    assert sorted(map(str, (tuple(r) for r in keys.differing_rows(left, right).collect()))) == sorted(map(str, [("a", 1, "left")] * 2 + [("b", None, "right"), ("c", 2, "right")]))
    many = spark.range(150_000).select(F.lit("a").alias("v"))
    assert keys.differing_rows(many, many.limit(1)).groupBy("side").count().first()["count"] == 149_999


def test_one_csv_file_has_the_same_bytes(spark, tmp_path):
    rows = spark.range(3_000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('a "q", '), F.col("id").cast("string"), F.lit("\n"))).alias("a, b"))
    for n in (1, 64):
        readers.write_csv_file(rows.repartition(n), str(tmp_path / f"{n}.csv"), ["k"])
    assert (tmp_path / "1.csv").read_bytes() == (tmp_path / "64.csv").read_bytes()
    assert (tmp_path / "1.csv").read_text().startswith('k,"a, b"\n0,')
    assert readers.read_csv_text(spark, str(tmp_path / "64.csv")).count() == 3_000
    with pytest.raises(DataError, match="already"):
        readers.write_csv_file(rows, str(tmp_path / "1.csv"), ["k"])
    readers.write_csv_file(rows.limit(0), str(tmp_path / "none.csv"), ["k"])
    assert (tmp_path / "none.csv").read_text() == 'k,"a, b"\n'
    assert not [f for f in os.listdir(tmp_path) if not f.endswith((".csv", ".crc"))]


def test_large_files_are_hashed_in_blocks(spark, tmp_path):
    (tmp_path / "s mall.bin").write_bytes(b"x" * 1_000)
    (tmp_path / "empty.bin").write_bytes(b"")
    with open(tmp_path / "large file%20.bin", "wb") as file:
        file.write(b"head")
        file.truncate(3 << 30)  # sparse
    block, h = bytes(1 << 20), hashlib.sha256(b"head" + bytes((1 << 20) - 4))
    for _ in range((3 << 10) - 1):
        h.update(block)
    found = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in readers.file_digests(spark, str(tmp_path)).collect()}
    assert found == {"s mall.bin": hashlib.sha256(b"x" * 1_000).hexdigest(), "empty.bin": hashlib.sha256().hexdigest(), "large file%20.bin": h.hexdigest()}


def test_text_files_come_all_or_none(spark, tmp_path):
    spark.dataSource.register(TextFiles)
    root = str(tmp_path / "out")

    def put(rows):
        rows.write.format("text_files").mode("append").save(root)

    rows = spark.range(200).select(F.format_string("r%d/%d.txt", F.col("id") % 3, "id").alias("path"), F.when(F.col("id") > 0, F.concat(F.lit("\u00e9"), "id")).alias("text")).repartition(6)
    put(rows)
    found = {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), encoding="utf-8").read() for d, _, files in os.walk(root) for f in files}
    assert found == {f"r{k % 3}/{k}.txt": f"\u00e9{k}" if k else "" for k in range(200)}
    put(rows.filter("path = 'r1/1.txt'").withColumn("text", F.lit("new")))
    assert open(f"{root}/r1/1.txt").read() == "new"
    fails = F.when(F.col("path") == "r2/101.txt", F.raise_error(F.lit("stop"))).otherwise(F.lit("late"))
    for bad in (rows.withColumn("text", fails), rows.withColumn("path", F.lit("../x.txt")), rows.withColumn("path", F.lit("same.txt")), rows.withColumn("path", F.lit(None).cast("string"))):
        with pytest.raises(Exception):
            put(bad)
        assert sorted(os.listdir(root)) == ["r0", "r1", "r2"] and open(f"{root}/r1/1.txt").read() == "new" and not os.path.exists(tmp_path / "x.txt")


def test_exported_letters_have_one_file_each(spark, tmp_path):
    twice = spark.createDataFrame([("RA1", "A-1", "x"), ("RA2", "A-1", "y")], "assigned_ra string, application_id string, letter string")
    letters.write_letters(twice, str(tmp_path / "table"))
    with pytest.raises(DataError, match="letters"):
        letters.export_letters(spark, str(tmp_path / "table"), str(tmp_path / "files"))


def test_table_function_in_sql(spark):
    readers.register_office_rows(spark)
    page = "<table><tr><td>1</td><td>Office</td><td></td></tr></table>"
    pages = spark.createDataFrame([(1, page, None), (2, None, "u"), (3, "<p>", "u"), (4, page * 2, "u")], "id int, html string, url string")
    found = spark.sql("select id, o.* from {pages} p, lateral office_rows(p.html, p.url) o", pages=pages).collect()
    assert sorted(map(tuple, found)) == [(1, "Office", "", "", True), (4, "Office", "", "", True), (4, "Office", "", "", True)]
