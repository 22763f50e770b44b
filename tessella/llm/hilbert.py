"""Hilbert-curve sharding: quantise metadata, order rows along the curve, cut runs of equal row counts.

Files cut as runs of the curve keep every quantised dimension narrow at once, so a filter on source,
language or size prunes most shards by their min/max statistics.

Defined cases: a null text counts 8 bytes and crc32 null; a null language or source takes its own cell
(code 0); a null doc_id sorts first; rows that tie in every ordering column are interchangeable; an
empty table gives an empty result. Only doc_id, text, lang and source are read, so extra columns with
any name do no harm.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import materialise, partitions_of

BITS = 6  # per dimension
DIMENSIONS = ("source_code", "lang_code", "size_code")


@cache
def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """For n dimensions, (digit, next state) of every state * 2^n + octant.

    A state is an entry corner e and an axis d (e * n + d). From Gray codes: the octant is turned by
    T(b) = rotate_right(b xor e, d + 1), its rank w is the inverse Gray code of that, and the state of
    the sub-cube follows from the entry corner and axis of rank w.
    """
    size = 1 << n
    ror = lambda x, k: ((x >> (k % n)) | (x << (n - k % n))) & (size - 1)
    rol = lambda x, k: ror(x, n - k % n)
    gray = lambda i: i ^ (i >> 1)
    rank = {gray(i): i for i in range(size)}
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # trailing ones of i
    entry = lambda i: 0 if i == 0 else gray(2 * ((i - 1) // 2))
    axis = lambda i: 0 if i == 0 else (ones(i - 1) if i % 2 == 0 else ones(i)) % n
    digits, states = [], []
    for e in range(size):
        for d in range(n):
            for octant in range(size):
                w = rank[ror(octant ^ e, d + 1)]
                digits.append(w)
                states.append((e ^ rol(entry(w), d + 1)) * n + (d + axis(w) + 1) % n)
    return digits, states


def hilbert_index(codes: list[Column], bits: int = BITS) -> Column:
    """Position along the Hilbert curve of a cell given by equal-width codes (0 to 2^bits - 1)."""
    n = len(codes)
    digits, states = (F.array(*map(F.lit, t)) for t in curve_tables(n))

    def step(acc: Column, level: Column) -> Column:
        octant = F.lit(0)
        for k, code in enumerate(codes):
            bit = F.call_function("shiftright", code, level.cast("int")).bitwiseAND(F.lit(1))
            octant = octant + bit * F.lit(1 << k)
        at = acc["state"] * F.lit(1 << n) + octant + F.lit(1)
        return F.struct(
            F.element_at(states, at.cast("int")).alias("state"),
            (acc["h"] * F.lit(1 << n).cast("long") + F.element_at(digits, at.cast("int"))).alias("h"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda acc: acc["h"])


def _hash_code(name: str, bits: int = BITS) -> Column:
    """A category's cell: 0 for null, else 1 + the md5 prefix modulo 2^bits - 1 (no dictionary of categories is needed)."""
    prefix = F.conv(F.substring(F.md5(F.col(name).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.lit(1) + prefix % F.lit((1 << bits) - 1), F.lit(0)).cast("int")


def _size_code(size: Column, bits: int = BITS) -> Column:
    """Logarithmic size class in half octaves: twice the bit length plus the second highest bit."""
    length = F.length(F.bin(size))
    second = F.when(length > 1, F.substring(F.bin(size), 2, 1).cast("int")).otherwise(F.lit(0))
    return F.least(F.lit((1 << bits) - 1), length * 2 + second).cast("int")


def curve_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the quantised dimensions and the curve index of every row."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(8)
    rows = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        _hash_code("source").alias("source_code"),
        _hash_code("lang").alias("lang_code"),
    ).withColumn("size_code", _size_code(F.col("size")))
    return rows.withColumn("hilbert", hilbert_index([F.col(c) for c in DIMENSIONS]))


def hilbert_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Assign every row a shard (counts at most one apart) and a gapless slot in it.

    Rows are range-partitioned by (curve index, doc_id), which splits a hot cell like any other run;
    a row's global rank is its place in its partition plus the rows of the partitions before. The only
    global step sums one count per partition.
    """
    spark = docs.sparkSession
    order = ["hilbert", "doc_id", "size", "text_crc32"]
    # A written table fixes the places: a recomputed range exchange could cut at other bounds.
    placed = materialise(
        curve_rows(docs)
        .repartitionByRange(partitions_of(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "hilbert",
    )
    part, local = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    rows = placed.withColumn("part", part).withColumn("local", local)
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("part").alias("part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"),
    )
    # One row per partition of the exchange above: bounded by the session's partition count.
    ranked = rows.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("local"))
    shard = F.expr(f"cast(rank * {shards} div total as int)")
    first = F.expr(f"((cast(rank * {shards} div total as long) * total + {shards - 1}) div {shards})")
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"),
        (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "hilbert", *DIMENSIONS,
    )


def shard_manifest(assigned: DataFrame) -> DataFrame:
    """Min and max of every pruning dimension per shard: what a reader needs to skip whole shards."""
    stats = [f(c).alias(f"{c}_{n}") for c in (*DIMENSIONS, "hilbert", "doc_id") for n, f in (("min", F.min), ("max", F.max))]
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"), *stats)


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write docs as one folder per shard, in curve order inside its files (joined by doc_id, which must be unique and not null here).

    Ranges of (shard, slot) are dealt to tasks, so a shard larger than a task becomes several files.
    """
    keyed = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    ranged = keyed.repartitionByRange(partitions_of(docs.sparkSession), "shard", "slot")
    ranged.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
