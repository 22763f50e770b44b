"""Near-duplicates by an LSH forest over MinHash signatures.

Every distinct shingle set gets TREES * DEPTH minimum hashes. A tree is the list of all sets sorted by one order of the signature (its own DEPTH hashes,
then those of the trees after it), so sets that agree in many leading hashes lie next to each other: the neighbours of a set have the longest common
prefixes with it. A region is a run with one prefix of DEPTH hashes; in a crowded region neighbours share longer prefixes, so the depth adapts to it.

The first pass sorts all sets by eight hashes and compares adjacent ones. The regions of three and more sets that then still hold several components
are taken again in rounds, sorted by the whole signature: each set meets the NEIGHBOURS sets of other components before and after it, the candidates are
confirmed, components merge, and the next round looks across the merged ones, until a round finds no link. A set so has at most 2 * NEIGHBOURS * TREES
candidates a round, however large its group is. Pairs whose sketches differ in more bits than the sets may differ in shingles go, which no pair of
the wanted similarity does.

What windows of NEIGHBOURS leave out is made good exactly: the sets of regions of more sets, or cut by a partition's end, that hold several
components at the end are joined on the rarest shingles of each (a prefix filter with bounds of length and position), between components only. A list
of one shingle holding over BLOCK sets is dealt over cells of its blocks.

Candidates are confirmed on the full sets; links are merged within tasks, and by alternating large and small stars where they need several. Sets that
differ in no shingle are one class from the start, so exact copies never meet in one task.

A pair of similarity 0.8 shares a tree's first four hashes with probability 0.41, hence is missed by all 24
trees with probability 3e-6; of the sets that met in a crowded region no pair is missed.

Defined cases: null and empty texts, and texts without words, have the empty set, 0 shingles, and are linked with nothing;
rows sharing a doc_id count as one document holding the links of all of them; a null doc_id is linked with
nothing; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import materialise, partitions_of
from tessella.sources.shared import counted

TREES = 24
DEPTH = 4  # hashes a tree has of its own
NEIGHBOURS = 8  # sets of other components on either side that a set meets in a round
PIECE = 256  # neighbouring sets of a region that share a key where regions are joined
FIRST_TREES = 12  # trees whose adjacent sets the first pass compares in regions of three and more
RARITY = 1 << 20  # hashed counts by which shingles are ordered; any order gives the same pairs
BLOCK = 2048  # sets of one shingle's list that a task compares with as many others
SORTED_ROWS = 1_000_000  # rows of a sorted order that one task holds (48 bytes each)
TASK_LINKS = 500_000  # links that one task contracts (16 bytes each)
FILTER_BITS = 1 << 26  # fixed size of the filter of sets that have candidates: 8 MB
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PLACES = 64  # bytes of a word that is hashed by places
_IN_WORD = np.array([bool(WORD.match(bytes([c]))) for c in range(256)])
_NUMBERS = np.random.default_rng(20240701).integers(0, 1 << 64, PLACES << 8, dtype=np.uint64)
SKETCH = 1024  # bits of a set's sketch
SIGNATURE_COLUMNS = ["doc_id", "n_shingles", "digest", "signature", "sketch"]
SIGNATURE_SCHEMA = "doc_id long, n_shingles long, digest binary, signature binary, sketch binary"
PAIR_SCHEMA = "kind int, a long, b long, tree int, p1 long"


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order: the sum of one random number for each place and byte; words of more than PLACES bytes by their digest."""
    raw, inside = np.frombuffer(text, np.uint8), np.zeros(len(text) + 2, bool)
    inside[1:-1] = _IN_WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    out = np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), 4096):  # bounded memory for very long texts
        at, n = starts[k : k + 4096], np.minimum(lengths[k : k + 4096], PLACES)
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(first, n)
        out[k : k + 4096] = np.add.reduceat(_NUMBERS.take(place << 8 | raw[np.repeat(at, n) + place]), first)
    for k in np.flatnonzero(lengths > PLACES).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(text[starts[k] : starts[k] + lengths[k]], digest_size=8).digest(), "little")
    return out


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (with fewer words, of the whole sequence)."""
    found = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
    if not len(found):
        return np.empty(0, np.uint64)
    k = min(words, len(found))
    h = np.full(len(found) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ found[i : len(found) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h.sort()
    return h[np.r_[True, h[1:] != h[:-1]]]


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, count, dtype=np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over the set, the upper 16 of 32 bits mixed to even them out."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 256):  # bounded memory for very long texts
        low = np.minimum(low, (hashes[at : at + 256, None] * a + b).min(axis=0))
    low ^= low >> np.uint64(33)
    return ((low * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(48)).astype(np.uint16)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of SKETCH bits: two sketches differ in no more bits than their sets in shingles."""
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def _alike(sketches: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches leave it possible that rows i and j are similar enough; False is certain."""
    out = np.zeros(len(i), bool)
    for k in range(0, len(i), 65_536):
        x, y = i[k : k + 65_536], j[k : k + 65_536]
        differ = np.bitwise_count(sketches[x] ^ sketches[y]).sum(axis=1, dtype=np.int64)
        out[k : k + 65_536] = differ * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
    return out


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, set size, set digest, signature and sketch of every row; texts are read once and never shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers(TREES * DEPTH)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = shingle_hashes(text, words)
                rows.append((doc_id, len(h), hashlib.blake2b(h.tobytes(), digest_size=16).digest(), signature(h, a, b).tobytes() if len(h) else b"", sketch(h).tobytes()))
            ids, n, digest, sig, bits = zip(*rows) if rows else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(bits, pa.binary())], SIGNATURE_COLUMNS)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SIGNATURE_SCHEMA)


def forest_rows(classes: DataFrame) -> DataFrame:
    """A row for each set and tree: tree, the first and the second DEPTH hashes of its order, id, size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            sig = np.frombuffer(b"".join(frame["signature"]), np.uint16).reshape(len(frame), TREES, DEPTH).astype(np.int64)
            packed = (sig[:, :, 0] << 48) | (sig[:, :, 1] << 32) | (sig[:, :, 2] << 16) | sig[:, :, 3]
            after = np.roll(packed, -1, axis=1)
            yield pd.DataFrame(
                {
                    "tree": np.tile(np.arange(TREES, dtype=np.int32), len(frame)),
                    "p1": packed.ravel(),
                    "p2": after.ravel(),
                    "id": np.repeat(frame["id"].to_numpy(np.int64), TREES),
                    "n": np.repeat(frame["n"].to_numpy(np.int64), TREES),
                }
            )

    return classes.select("id", "n", "signature").mapInPandas(run, "tree int, p1 long, p2 long, id long, n long")


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Number of the run that each row of sorted keys lies in."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _whole(frames: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    """One partition's narrow sorted rows; the exchange before bounds their number."""
    kept = [f for f in frames if len(f)]
    return pd.concat(kept, ignore_index=True) if kept else None


def _similar_sizes(n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n[i], n[j]) * 100 >= percent * np.maximum(n[i], n[j])


def first_candidates(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """kind 0: candidate pairs (a, b) of adjacent rows, in regions of two and in the first trees; kind 1: the rows of regions of three and more, or cut by the partition's end (a = id, b = the id that its piece begins with)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _whole(frames)
        if t is None:
            return
        tree, p1, p2, ids, n = (t[c].to_numpy() for c in ("tree", "p1", "p2", "id", "n"))
        region = _starts(tree, p1)
        size = np.bincount(region)[region]
        cut = (region == region[0]) | (region == region[-1])  # may go on in the next partition
        i = np.flatnonzero((region[1:] == region[:-1]) & ((tree[1:] < FIRST_TREES) | (size[1:] == 2)))
        i = i[_similar_sizes(n, i, i + 1, percent)]
        yield _pairs(ids[i], ids[i + 1])
        left = (size > 2) | cut
        first = np.searchsorted(region, region)
        piece = ids[first + (np.arange(len(t)) - first) // PIECE * PIECE]
        yield pd.DataFrame({"kind": np.int32(1), "a": ids[left], "b": piece[left], "tree": tree[left], "p1": p1[left]})

    return _sorted(rows, ["tree", "p1", "p2", "id"], parts).mapInPandas(run, PAIR_SCHEMA)


def _parts(spark: SparkSession, rows: int) -> int:
    """Partitions for a sorted order: the session's number, more where they would hold over SORTED_ROWS rows each."""
    return max(partitions_of(spark), -(-rows // SORTED_ROWS))


def _sorted(rows: DataFrame, order: list[str], parts: int) -> DataFrame:
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def _pairs(x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
    """Each pair of different ids once."""
    keep = x != y
    x, y = x[keep], y[keep]
    found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
    return pd.DataFrame({"kind": np.int32(0), "a": found[:, 0], "b": found[:, 1], "tree": np.int32(0), "p1": np.int64(0)})


def mixed_regions(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """tree, p1, piece and number of sets of the region, for every piece of the regions that hold several components."""
    marked = crowded.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    # Only a row for each piece meets the others of its region; the sets themselves are joined by piece, so that no region is one task.
    found = marked.groupBy("tree", "p1", "piece").agg(F.count("*").alias("sets"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    region = Window.partitionBy("tree", "p1")
    whole = {"sets": F.sum("sets").over(region), "least": F.min("least").over(region), "most": F.max("most").over(region)}
    return found.withColumns(whole).filter("least != most").select("tree", "p1", "piece", "sets")


def round_rows(crowded: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of mixed regions, with component, sketch and the signature in the order of their tree."""
    rows = crowded.join(mixed_regions(crowded, labels).drop("sets"), ["tree", "p1", "piece"])
    marked = rows.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id")).join(classes.select("id", "n", "signature", "sketch"), "id")
    turned = F.concat(F.expr(f"substring(signature, tree * {2 * DEPTH} + 1)"), F.expr(f"substring(signature, 1, tree * {2 * DEPTH})"))
    return marked.select("tree", "p1", turned.alias("order"), "id", "comp", "n", "sketch")


def _others(comp: np.ndarray, region: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every row, the NEIGHBOURS next rows of its region that are of other components."""
    size = len(comp)
    change = np.flatnonzero(np.r_[comp[1:] != comp[:-1], True]) + 1
    after = change[np.searchsorted(change, np.arange(size), side="right")]  # the first row behind the run of one component
    i = np.arange(size)
    j = after.copy()
    for _ in range(NEIGHBOURS):
        fits = j < size
        i, j = i[fits], j[fits]
        own = comp[i] == comp[j]
        j[own] = after[j[own]]
        fits = j < size
        fits[fits] = region[i[fits]] == region[j[fits]]
        i, j = i[fits], j[fits]
        if not len(i):
            return
        yield i, j
        j = j + 1


def round_candidates(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """kind 0: pairs (a, b) of neighbours of different components; kind 1: the regions (tree, p1) at a partition's ends."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _whole(frames)
        if t is None:
            return
        tree, p1, ids, n, comp = (t[c].to_numpy() for c in ("tree", "p1", "id", "n", "comp"))
        sketches = np.frombuffer(b"".join(t["sketch"]), np.uint64).reshape(len(t), SKETCH // 64)
        region, last = _starts(tree, p1), len(t) - 1
        found = []
        for i, j in _others(comp, region):
            found.append((i, j))
        for i, j in _others(comp[::-1], region[::-1]):
            found.append((last - i, last - j))
        if found:
            i, j = (np.concatenate(x) for x in zip(*found))
            fits = _similar_sizes(n, i, j, percent)
            i, j = i[fits], j[fits]
            fits = _alike(sketches, n, i, j, percent)
            yield _pairs(ids[i[fits]], ids[j[fits]])
        ends = [0, last]
        yield pd.DataFrame({"kind": np.int32(1), "a": np.int64(0), "b": np.int64(0), "tree": tree[ends], "p1": p1[ends]})

    return _sorted(rows, ["tree", "p1", "order", "id"], parts).mapInPandas(run, PAIR_SCHEMA)


def _slots(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(31))) % np.uint64(FILTER_BITS)).astype(np.int64)


def candidate_filter(pairs: DataFrame) -> bytes:
    """A bit for each hashed id that occurs in a pair: FILTER_BITS in all, however many pairs there are.

    At most FILTER_BITS / 64 words reach the driver. Full, the filter lets every text through, which costs
    time and changes no result.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(FILTER_BITS // 64, np.uint64)
        for frame in frames:
            at = _slots(frame["id"].to_numpy())
            np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        yield pd.DataFrame({"word": used.astype(np.int32), "bits": words[used].view(np.int64)})

    merged = ids.mapInPandas(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    table = merged.toArrow()
    words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return words.tobytes()


def candidate_sets(docs: DataFrame, members: DataFrame, keep: bytes, words: int) -> DataFrame:
    """id and full set of every class representative that the filter lets through."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = _slots(ids)
            hit = np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            texts = batch.column(1).take(pa.array(hit)).to_pylist()
            sets = [shingle_hashes(t, words).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit], pa.int64()), pa.array(sets, pa.binary())], ["id", "shingles"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "id long, shingles binary")
    return found.join(members.select("id"), "id", "left_semi")


@F.pandas_udf(T.BinaryType())
def _sketches(sets: pd.Series) -> pd.Series:
    return sets.map(lambda s: sketch(np.frombuffer(s, np.uint64)).tobytes())


@F.pandas_udf(T.BooleanType())
def _linked(a: pd.Series, b: pd.Series, percent: pd.Series) -> pd.Series:
    out = np.zeros(len(a), bool)
    for k, (x, y, p) in enumerate(zip(a, b, percent)):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out[k] = 100 * both >= p * (len(x) + len(y) - both)
    return pd.Series(out)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
    return joined.filter(_linked("set_a", "set_b", F.lit(percent))).select("a", "b").distinct()


def rarity(sets: DataFrame) -> bytes:
    """How many sets hold a shingle, counted by hash in RARITY places: a fixed size however many shingles there are."""
    block = RARITY // 16

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(RARITY, np.int64)
        for frame in frames:
            for s in frame["shingles"]:
                np.add.at(counts, (np.frombuffer(s, np.uint64) % np.uint64(RARITY)).astype(np.int64), 1)
        if counts.any():
            yield pd.DataFrame({"block": np.arange(16, dtype=np.int32), "counts": [counts[k * block : (k + 1) * block].tobytes() for k in range(16)]})

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        counts = sum(np.frombuffer(c, np.int64) for c in frame["counts"])
        return pd.DataFrame({"block": frame["block"].iloc[:1], "counts": [np.minimum(counts, 2**31 - 1).astype(np.int32).tobytes()]})

    parts = sets.select("shingles").mapInPandas(run, "block int, counts binary").groupBy("block").applyInPandas(total, "block int, counts binary")
    found = dict(parts.collect())
    return b"".join(bytes(found.get(k, bytes(4 * block))) for k in range(16))


def prefixes(sets: DataFrame, counts: bytes, percent: int) -> DataFrame:
    """shingle, id, key (hash of the set), comp, n and place in the set for the rarest shingles of every set: two sets of the wanted likeness share one.

    Of n shingles at least percent are shared, so one shared shingle has at least as many at or after it.
    """
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = np.frombuffer(shared.value, np.int32)
        for frame in frames:
            if not len(frame):
                continue
            shingle, place, size = [], [], []
            for s in frame["shingles"]:
                h = np.frombuffer(s, np.uint64)
                c = often[(h % np.uint64(RARITY)).astype(np.int64)]
                order = np.lexsort((h, c))[: len(h) * (100 - percent) // 100 + 1]
                at = np.flatnonzero(c[order] > 1)  # counted once: no other set has it
                shingle.append(h[order[at]].view(np.int64))
                place.append(at.astype(np.int32))
                size.append(len(h))
            times = [len(at) for at in place]
            of_set = {"id": frame["id"].to_numpy(np.int64), "key": frame["key"].to_numpy(np.int64), "comp": frame["comp"].to_numpy(np.int64), "n": np.array(size, np.int32)}
            yield pd.DataFrame({"shingle": np.concatenate(shingle), **{c: np.repeat(v, times) for c, v in of_set.items()}, "place": np.concatenate(place)})

    return sets.select("id", "key", "comp", "shingles").mapInPandas(run, "shingle long, id long, key long, comp long, n int, place int")


def cells(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The rows of every shingle that can make a pair, with their sketches, dealt over cells: each two rows of a shingle meet in exactly one.

    The smaller set of a pair shares at least 2 * percent / (100 + percent) of itself; a list without such a row has no pair.
    """
    small = (F.col("n") - F.col("place")).cast("long") * (100 + percent) >= F.col("n").cast("long") * (2 * percent)
    lists = rows.groupBy("shingle").agg(F.count("*").alias("rows"), F.max(small).alias("able"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    lists = lists.filter("able and least != most").select("shingle", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    salted = rows.join(lists, "shingle").join(sketches, ["id", "key"]).withColumn("salt", F.pmod(F.xxhash64("id", "shingle"), F.col("blocks")).cast("int"))
    other = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("shingle", F.least("salt", "other").alias("lo"), F.greatest("salt", "other").alias("hi"), "salt", "id", "comp", "n", "place", "sketch")


def cell_pairs(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """Pairs (a, b) of different components that bounds of length, of the first shared shingle's place and of sketches leave possible."""
    order = ["shingle", "lo", "hi", "n", "id"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _whole(frames)
        if t is None:
            return
        shingle, lo, hi, salt, ids, comp, n, place = (t[c].to_numpy() for c in ("shingle", "lo", "hi", "salt", "id", "comp", "n", "place"))
        n = n.astype(np.int64)
        sketches = np.frombuffer(b"".join(t["sketch"]), np.uint64).reshape(len(t), SKETCH // 64)
        cell, left = _starts(shingle, lo, hi), n - place
        found, j, step = [], np.arange(len(t)), 0
        while len(j):  # the larger set of a pair is step rows after the smaller
            step += 1
            j = j[j >= step]
            i = j - step
            j = j[(cell[i] == cell[j]) & (100 * n[i] >= percent * n[j])]  # sizes ascend in a cell: no row further up fits either
            i = j - step
            good = (comp[i] != comp[j]) & (ids[i] != ids[j]) & (np.minimum(left[i], left[j]) * (100 + percent) >= percent * (n[i] + n[j]))
            good &= (lo[i] == hi[i]) | (salt[i] != salt[j])
            x, y = i[good], j[good]
            good = _alike(sketches, n, x, y, percent)
            x, y = ids[x[good]], ids[y[good]]
            found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
            if sum(map(len, found)) > 4 * SORTED_ROWS:
                found = [np.unique(np.concatenate(found), axis=0)]
                if len(found[0]) > 2 * SORTED_ROWS:
                    yield pd.DataFrame(found.pop(), columns=["a", "b"])
        if found:
            yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    return rows.repartition(parts, "shingle", "lo", "hi").sortWithinPartitions(*order).mapInPandas(run, "a long, b long")


def exact_links(open_: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links between different components among the sets open_."""
    spark = sets.sparkSession
    marked = sets.join(open_, "id", "left_semi").join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    marked = materialise(marked.withColumn("key", F.xxhash64("shingles")).withColumn("sketch", _sketches("shingles")), "open")
    rows = materialise(prefixes(marked, rarity(marked), percent), "prefixes")
    dealt = materialise(cells(rows, marked.select("id", "key", "sketch").distinct(), percent), "cells")
    return confirm(cell_pairs(dealt, percent, _parts(spark, 4 * dealt.count())), marked, percent)


def contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """a, b: in each of so many tasks, every node of its links beside the smallest one that those reach; the same nodes hang together as before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]) for batch in batches if batch.num_rows]
        if not held:
            return
        nodes, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        x, y = at.reshape(2, -1)
        least = np.arange(len(nodes))  # places in nodes, which ascend as the ids do
        while len(x):
            np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
            while (further := least[least]).tobytes() != least.tobytes():
                least = further
            x, y = least[x], least[y]
            x, y = x[x != y], y[x != y]
        moved = np.flatnonzero(least != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[least[moved]])], names=["a", "b"])

    dealt = edges.coalesce(1) if tasks == 1 else edges.repartitionByRange(tasks, "b", "a")
    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id and the smallest id that links reach, for every id in a link but those smallest: links contracted task by task, then alternating large and small stars.

    A task contracts at most about TASK_LINKS links, so up to that many need one task and no star; more are dealt over more tasks.
    A star step is one aggregate and one join on the node; both sides of the join are shuffled, so that a hot
    node's rows can be split.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both if large else both.filter("b < a")
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = around.join(least, "a")
        if large:
            moved = moved.filter("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
        else:
            moved = moved.select(F.col("b").alias("x"), F.col("m").alias("y")).union(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
        return moved.filter("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()

    edges, count = counted(links.filter("a != b").select("a", "b"), "links")
    tasks = max(1, -(-count // TASK_LINKS))
    edges, before = contracted(edges, tasks), None
    if tasks == 1:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    edges = materialise(edges, "stars")
    while True:
        edges = materialise(star(star(edges, True), False), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == before or not now[0]:
            return edges.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("id"), "comp")
        before = now


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (whether it is its own)."""
    base = materialise(signatures(docs, words), "signatures")
    live = base.filter("n_shingles > 0 and doc_id is not null")
    classes = live.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "signature", "sketch")).alias("s"))
    classes = materialise(classes.select("digest", F.col("s.doc_id").alias("id"), F.col("s.n_shingles").alias("n"), "s.signature", "s.sketch"), "classes")
    spark = docs.sparkSession
    found = materialise(first_candidates(forest_rows(classes), percent, _parts(spark, classes.count() * TREES)), "candidates")
    pairs = found.filter("kind = 0").select("a", "b").distinct()
    crowded = found.filter("kind = 1").select("tree", "p1", F.col("b").alias("piece"), F.col("a").alias("id"))
    # The sets of crowded regions are kept beside those of the first candidates.
    wanted = found.select("a", F.when(F.col("kind") == 0, F.col("b")).otherwise(F.col("a")).alias("b"))
    sets = materialise(candidate_sets(docs, classes.select("id"), candidate_filter(wanted), words), "sets")
    labels = materialise(components(confirm(pairs, sets, percent)), "labels")
    labels = linked_regions(crowded, labels, classes, sets, pairs, percent)
    # Classes that share a smallest doc_id (rows of one id with several texts) are one node, as are all rows of one id.
    of_class = classes.select("digest", "id").join(labels, "id", "left").select("digest", F.coalesce("comp", "id").alias("comp"))
    rows = base.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    joined = rows.join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), (F.coalesce(component == F.col("doc_id"), F.lit(True))).alias("kept"))


def linked_regions(crowded: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """id and component after the rounds over crowded regions and the exact join of what their windows leave out."""

    def merged(more: DataFrame) -> DataFrame:
        # Earlier components stand for the links that made them.
        return materialise(components(labels.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(more)), "labels")

    n_crowded = crowded.count()
    while n_crowded:
        parts = _parts(crowded.sparkSession, 8 * n_crowded)  # rows are wider than the first pass's
        found = materialise(round_candidates(round_rows(crowded, labels, classes), percent, parts), "candidates")
        fresh = materialise(found.filter("kind = 0").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        more = materialise(confirm(fresh, sets, percent), "links")
        if more.isEmpty():
            cut = found.filter("kind = 1").select("tree", "p1", F.lit(True).alias("cut")).distinct()
            left = mixed_regions(crowded, labels).join(cut, ["tree", "p1"], "left").filter(f"cut or sets > {NEIGHBOURS + 1}").select("tree", "p1", "piece")
            open_ = materialise(crowded.join(left, ["tree", "p1", "piece"]).select("id").distinct(), "open-ids")
            if not open_.isEmpty():
                last = materialise(exact_links(open_, labels, sets, percent), "links")
                labels = labels if last.isEmpty() else merged(last)
            break
        labels, tested = merged(more), tested.union(fresh)
    return labels


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row for each group of near-duplicates: that of the smallest doc_id.

    Rows without words and rows without doc_id stay; rows sharing a doc_id stay or go together.
    """
    kept = near_duplicates(docs, words, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    mine = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    return mine.union(docs.filter("doc_id is null").select(docs.columns))
