"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; its window is 32 bytes, so a cut depends on nearby content only and an insertion moves no later cut.
Cuts are normalised: from MIN bytes to AVERAGE a hash must match a hard mask, from there to MAX an easy one, and MAX cuts at once. The fingerprint is
the set of (chunk digest, chunk length); containment of a document in another is the length of its chunks that the other has, over its own length.

Edited texts need each document's successor by doc_id: documents are dealt by ranges of doc_id to tasks that stream them in order, and the first
document of a range is dealt to the range before as well. Ranges hold about TASK_BYTES of text, and no task holds more than two texts and one batch.

Defined cases: a null text is an empty one; an empty text has the empty fingerprint, likeness 1 to another empty text and 0 to any other; a single document
follows itself; rows with one doc_id follow in order of text; rows without doc_id come last, in the order of a hash of their texts; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import local_table, partitions_of

MIN, AVERAGE, MAX = 16, 64, 256
HARD, EASY = np.uint32(0xFF000000), np.uint32(0xF0000000)  # eight and four bits
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)], np.uint32)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The gear hash after every byte: sum of GEAR[byte] << age over the last 32 bytes, by doubling the window five times."""
    h = GEAR[raw]
    for width in (1, 2, 4, 8, 16):
        if len(h) <= width:
            break
        older = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += older
    return h


def cuts(data: bytes) -> list[int]:
    """End of every chunk."""
    if len(data) <= MIN:
        return [len(data)] if data else []
    h = gear_hashes(np.frombuffer(data, np.uint8))
    easy = np.flatnonzero((h & EASY) == 0)
    hard = easy[(h[easy] & HARD) == 0]
    easy, hard = (easy + 1).tolist(), (hard + 1).tolist()
    ends, start, size = [], 0, len(data)
    while size - start > MIN:
        k = bisect_left(hard, start + MIN)
        if k < len(hard) and hard[k] < start + AVERAGE:
            start = hard[k]
        else:
            k = bisect_left(easy, start + AVERAGE)
            end = easy[k] if k < len(easy) else size
            start = min(end, start + MAX, size)
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


def chunk_set(data: bytes) -> dict[bytes, int]:
    """Digest -> length of every distinct chunk."""
    found, start = {}, 0
    for end in cuts(data):
        found[hashlib.blake2b(data[start:end], digest_size=8).digest()] = end - start
        start = end
    return found


def containment(own: dict[bytes, int], other: dict[bytes, int]) -> float:
    """Length of own's chunks that other holds, over own's length."""
    if not own:
        return 1.0 if not other else 0.0
    return sum(n for d, n in own.items() if d in other) / sum(own.values())


def encoded(chunks: dict[bytes, int]) -> str:
    """Base64 of the sorted digests, each with its length in two bytes."""
    return base64.b64encode(b"".join(d + n.to_bytes(2, "big") for d, n in sorted(chunks.items()))).decode()


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below value, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.element_at(table, F.least(middle + 1, F.lit(len(bounds)))) <= value
        go = acc["lo"] < acc["hi"]
        return F.struct(F.when(go & below, middle + 1).otherwise(acc["lo"]).alias("lo"), F.when(go & ~below, middle).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), start, step, lambda acc: acc["lo"])


TASK_BYTES = 1 << 26  # text that a task streams
MOST_RANGES = 20_000


def _ranges(rows: DataFrame) -> tuple[int, int]:
    """Ranges of known doc_ids and, as a power of two, of rows without one: by the bytes of their texts, so that tasks keep their size as the table grows."""
    size = F.octet_length("text").cast("long")
    total = rows.agg(F.sum(F.when(F.col("doc_id").isNotNull(), size)).alias("known"), F.sum(F.when(F.col("doc_id").isNull(), size)).alias("null")).first()
    known, null = (-(-(b or 0) // TASK_BYTES) for b in (total["known"], total["null"]))
    return min(MOST_RANGES, max(partitions_of(rows.sparkSession), known)), (min(MOST_RANGES, null) - 1).bit_length() if null > 1 else 0


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, tail, doc_id, place, text) sorted within tasks: a range's documents in order of place and text, then the document after them (tail 1).

    place is the doc_id; rows without one come last, in the order of a hash of their texts, whose leading bits deal them over ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts, bits = _ranges(rows)
    quantiles = rows.filter("doc_id is not null").approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = sorted({int(q) for q in quantiles})
    hashed = F.shiftrightunsigned(F.xxhash64("text"), 1)
    null_range = F.lit(len(bounds)) + F.lit(1) + (F.shiftright(hashed, 63 - bits).cast("int") if bits else F.lit(0))
    rows = rows.withColumns({"place": F.coalesce("doc_id", hashed), "range": F.when(F.col("doc_id").isNull(), null_range).otherwise(_range_of(F.col("doc_id"), bounds))})
    # One head for each range: at most 2 * MOST_RANGES rows reach the driver.
    heads = sorted((r["range"], r["head"]) for r in rows.groupBy("range").agg(F.min("place").alias("head")).collect())
    if not heads:
        return rows.withColumn("tail", F.lit(0))
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("to", T.IntegerType())])
    before = local_table(spark, [(r, p, heads[k - 1][0]) for k, (r, p) in enumerate(heads)], schema)  # the first range follows the last
    first = rows.join(F.broadcast(before), ["range", "place"]).groupBy("to", "doc_id", "place").agg(F.min("text").alias("text"))
    tails = first.select("doc_id", "text", "place", F.col("to").alias("range"), F.lit(1).alias("tail"))
    dealt = rows.withColumn("tail", F.lit(0)).unionByName(tails)
    return dealt.repartition(max(parts, len(heads)), "range").sortWithinPartitions("range", "tail", "place", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each document: its fingerprint, the edited text's, and the likeness to that and to the next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held = None
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, part, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "range", "tail"))):
                chunks = chunk_set(text.encode("utf-8", "surrogatepass"))
                if held is not None and held[2] == part:
                    own_id, own_text, _, own = held
                    half = len(own_text) // 2
                    edited = (own_text[: len(own_text) - half] + text[:half]).encode("utf-8", "surrogatepass")
                    changed = chunk_set(edited)
                    out.append((own_id, len(own_text), hashlib.sha256(edited).hexdigest(), encoded(own), encoded(changed), containment(own, changed), containment(own, chunks)))
                held = None if tail else (doc_id, text, part, chunks)
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return with_next(docs).select("doc_id", "text", "range", "tail").mapInArrow(run, SCHEMA)
