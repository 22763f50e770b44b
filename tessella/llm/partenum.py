"""Exact similarity join of shingle sets by PartEnum signatures.

Sizes are cut into units, each reaching from l to l / similarity, so that linked sets lie in one unit or in neighbouring ones. A band is three units, and every second unit
belongs to two bands; a set makes signatures for its one or two bands. Linked sets of a band differ in at most k shingles, a number that the band's largest size gives. The domain of shingles is hashed into groups, and a group
into three parts (two where k is large). Of k // 2 + g groups at least g hold at most one difference, so that all their parts but one are equal: the signatures are, for
every group, the hashes of all subsets of its parts that leave one out. Two linked sets share at least one signature, so the join loses nothing.

A subset without shingles is equal in many sets, so it makes no signature, unless a set has so many groups with such a subset (hollow groups) that those could be the only
ones which a linked set shares: g or more. Such a set is hashed again with another seed, and so on for ATTEMPTS seeds; two sets that are hollow under all of them meet by the
empty subsets' signatures as well.

Documents of equal sets are one class. Each map task makes the signatures of a class once, for the first of its documents there, so that a large group of copies gives
some rows a task; those documents are linked with their class. Signatures are sorted over ranges. First a few signatures of every set meet their neighbours in the order; the
candidates are confirmed on the full sets, and components form, so that most of a group of near copies is one component. Then all signatures are sorted, and only buckets with documents of several components go on, dealt over cells of blocks, which no bucket is too large for. In a cell every
pair of different components is tried by sizes and sketches. One possible pair of two components and task is confirmed first, since one link merges them, in one of PART buckets and then in all; rounds go on with MORE times as many in the buckets that had others, until no possible pair between components is left out.

Defined cases: null and empty texts, and texts without words, have the empty set, 0 shingles, and are linked with nothing; rows sharing a doc_id count as one document
holding the links of all of them; a null doc_id is linked with nothing; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm import minhash
from tessella.llm.common import materialise, partitions_of, small_batches
from tessella.llm.minhash import SKETCH, _alike, _slots, candidate_filter, components, confirm, shingle_hashes, sketch
from tessella.sources.shared import counted

FIRST = 8  # signatures of a band whose neighbours the first pass compares
THREE_PARTS = 24  # differences up to which a group has three parts; two beyond, which makes a third fewer signatures
PART = 8  # the first round takes one in so many buckets
MORE = 64  # times as many pairs of two components as in the round before
ATTEMPTS = 4  # seeds for sets with hollow groups
SLICE = 4 << 20  # bytes of signatures in one record batch
SORTED_ROWS = 2_000_000  # signatures that one task of a sorted order holds (24 bytes each)
CELL_ROWS = 250_000  # rows with sketches that one task of the cells holds

BASE = "doc_id long, n_shingles long, digest binary, sketch binary, bits binary, first binary, signatures binary"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


@lru_cache(8)
def _units(percent: int) -> tuple[list[int], list[int]]:
    """The smallest and the largest size of every unit; linked sets lie in one unit or in neighbouring ones."""
    low, high = [], []
    size = 1
    while size < 1 << 40:
        low.append(size)
        high.append(size * 100 // percent)
        size = high[-1] + 1
    return low, high


def bands_of(size: int, percent: int) -> list[int]:
    """The bands of a set: band i spans the units 2i to 2i + 2, so that two neighbouring units always share a band."""
    unit = bisect_right(_units(percent)[0], size) - 1
    return [unit // 2] if unit % 2 or not unit else [unit // 2 - 1, unit // 2]


def differences(band: int, percent: int) -> int:
    """The most shingles in which two linked sets of a band differ: of a + b, 100 - percent in 100 + percent."""
    return 2 * _units(percent)[1][2 * band + 2] * (100 - percent) // (100 + percent)


@lru_cache(4096)
def scheme(band: int, percent: int) -> tuple[int, int, int]:
    """Groups of the domain for a band, parts of a group, and how many groups hold at most one difference at least.

    The last is chosen so that a set of the band's middle size seldom has as many hollow groups; any number gives right results.
    """
    k = differences(band, percent)
    parts, good = 3 if k <= THREE_PARTS else 2, 1
    low, high = _units(percent)
    size = (low[2 * band] * high[2 * band + 2]) ** 0.5
    while True:
        groups = k // 2 + good
        hollow = groups * parts * exp(-size * (parts - 1) / (groups * parts))
        if good > hollow + 3 * hollow**0.5 or good > k // 4 + 2:
            return groups, parts, good
        good += 1


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64((seed * 0x632BE59BD9B4E019 + 0x1B873593) & (2**64 - 1))) * _MIX[1]
    h = (h ^ (h >> np.uint64(32))) * _MIX[2]
    return h ^ (h >> np.uint64(29))


def band_signatures(hashes: np.ndarray, band: int, percent: int) -> np.ndarray:
    """The signatures of a set for one band; none where linked sets of the band are equal."""
    if not differences(band, percent):
        return np.empty(0, np.uint64)
    groups, parts, good = scheme(band, percent)
    tag = (np.arange(groups * parts, dtype=np.uint64) + np.uint64(band << 40)) * _MIX[0]
    out = []
    for seed in range(ATTEMPTS):
        mixed = _mixed(hashes, seed)
        part = ((mixed >> np.uint64(33)) % np.uint64(groups * parts)).astype(np.int64)
        sums = np.zeros(groups * parts, np.uint64)
        np.add.at(sums, part, mixed * _MIX[0])
        some = (np.bincount(part, minlength=groups * parts) > 0).reshape(groups, parts)
        told = _mixed(sums ^ tag, ATTEMPTS + seed).reshape(groups, parts)
        # A signature leaves out one part of its group.
        pairs = _mixed((told.sum(axis=1, dtype=np.uint64)[:, None] - told).ravel(), 2 * ATTEMPTS)
        full = (some.sum(axis=1)[:, None] - some > 0).ravel()
        hollow = int((~full.reshape(groups, parts).all(axis=1)).sum())
        out.append(pairs if seed + 1 == ATTEMPTS else pairs[full])
        if hollow < good:
            if seed + 1 == ATTEMPTS:
                out[-1] = pairs[full]
            break
    return np.concatenate(out)


def set_signatures(hashes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of a set for its one or two bands: those that the first pass takes, and all."""
    if not len(hashes):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    found = [band_signatures(hashes, band, percent) for band in bands_of(len(hashes), percent)]
    return np.concatenate([f[:FIRST] for f in found]), np.concatenate(found)


def fine_sketch(hashes: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each of 1024 or more bits, at least one a shingle: a short sketch is full for sets of some thousands."""
    width = max(SKETCH, 1 << max(len(hashes) - 1, 0).bit_length())
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % width, minlength=width) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def least_differences(a: bytes, b: bytes) -> int:
    """A lower bound of the shingles in which two sets differ, from their fine sketches; the longer is folded to the shorter's width."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        x, y = (x, y) if len(x) < len(y) else (y, x)
        half = len(y) // 2
        y = y[:half] ^ y[half:]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def signed_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, set size, digest, and sketch and signatures for the first row of a class in a task. Texts are read once and never shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # classes of this task's rows
        names = [c.split()[0] for c in BASE.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = shingle_hashes(text.as_py(), words)
                digest, short, bits, first, signs = hashlib.blake2b(h.tobytes(), digest_size=16).digest(), None, None, None, None
                if len(h) and doc_id is not None and digest not in seen:
                    seen.add(digest)
                    short, bits, (first, signs) = sketch(h).tobytes(), fine_sketch(h), (x.tobytes() for x in set_signatures(h, percent))
                    held += len(signs)
                rows.append((doc_id, len(h), digest, short, bits, first, signs))
                if held > SLICE:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)
            pa.default_memory_pool().release_unused()  # a worker's later tasks need other sizes

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BASE)


def signature_rows(signed: DataFrame) -> DataFrame:
    """sign, id and comp for every signature of (id, comp, signatures)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [np.frombuffer(s, np.int64) for s in batch.column(2).to_pylist()]
            if signs:
                at = pa.array(np.repeat(np.arange(len(signs)), [len(s) for s in signs]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(signs)), batch.column(0).take(at), batch.column(1).take(at)], names=["sign", "id", "comp"])

    return signed.select("id", "comp", "signatures").mapInArrow(run, "sign long, id long, comp long")


def _over_ranges(rows: DataFrame, count: int) -> DataFrame:
    """One bucket's rows in one partition or in neighbouring ones."""
    return rows.repartitionByRange(max(partitions_of(rows.sparkSession), -(-count // SORTED_ROWS)), "sign", "id")


def _sorted_columns(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray] | None:
    """One partition's columns by signature and id, equal rows once; the ranges bound their length."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    columns = [np.concatenate([b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for b in held]) for c in names]
    held.clear()
    sign, ids = columns[:2]
    order = np.lexsort((ids, sign))
    sign, ids = sign[order], ids[order]
    once = order[np.r_[True, (sign[1:] != sign[:-1]) | (ids[1:] != ids[:-1])]]
    return [c[once] for c in columns]


def first_pairs(rows: DataFrame, count: int) -> DataFrame:
    """Pairs (a, b) of documents next to each other in the order of signature and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _sorted_columns(batches, "sign", "id")
        if found is not None:
            sign, ids = found
            i = np.flatnonzero(sign[1:] == sign[:-1])
            pairs = np.unique(np.stack([ids[i], ids[i + 1]], axis=1), axis=0)  # ids ascend in a bucket
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return _over_ranges(rows, count).mapInArrow(run, "a long, b long")


def mixed_buckets(rows: DataFrame, count: int) -> DataFrame:
    """sign, id, comp of the buckets that hold several components or may go on in another range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _sorted_columns(batches, "sign", "id", "comp")
        if found is not None:
            sign, ids, comp = found
            new = np.r_[True, sign[1:] != sign[:-1]]
            starts, bucket = np.flatnonzero(new), np.cumsum(new) - 1
            mixed = np.minimum.reduceat(comp, starts) != np.maximum.reduceat(comp, starts)
            mixed[[0, -1]] = True
            keep = mixed[bucket]
            yield pa.RecordBatch.from_arrays([pa.array(sign[keep]), pa.array(ids[keep]), pa.array(comp[keep])], names=["sign", "id", "comp"])

    return _over_ranges(rows, count).mapInArrow(run, "sign long, id long, comp long")


def with_components(signed: DataFrame, labels: DataFrame) -> DataFrame:
    """id, comp, signatures. Only rows that a filter of fixed size takes for labelled meet the labels, so that the signatures of the others aren't shuffled."""
    shared = signed.sparkSession.sparkContext.broadcast(candidate_filter(labels.select(F.col("id").alias("a"), F.col("id").alias("b"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            at = _slots(batch.column(0).to_numpy(zero_copy_only=False))
            hit = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit.astype(bool))], names=["id", "signatures", "hit"])

    told = signed.select("id", "signatures").mapInArrow(run, "id long, signatures binary, hit boolean")
    joined = told.filter("hit").join(labels, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"), "signatures")
    return joined.union(told.filter("not hit").select("id", F.col("id").alias("comp"), "signatures"))


def bucket_pairs(cells: DataFrame, percent: int, most: int, parts: int) -> DataFrame:
    """a, b: possible pairs of different components in the cells, at most `most` of two components in a task; sign: buckets of which pairs were left out."""
    order = ["sign", "lo", "hi", "n", "id"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        t = pd.concat(held, ignore_index=True)
        sign, lo, hi, salt, ids, comp, n = (t[c].to_numpy() for c in ("sign", "lo", "hi", "salt", "id", "comp", "n"))
        n, sketches = n.astype(np.int64), np.frombuffer(b"".join(t["sketch"]), np.uint64).reshape(len(t), SKETCH // 64)
        cell = np.cumsum(np.r_[False, (sign[1:] != sign[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        kept, left, j, step = np.empty((0, 5), np.int64), [np.empty(0, np.int64)], np.arange(len(t)), 0
        while len(j):  # the larger set of a pair is step rows after the smaller
            step += 1
            j = j[j >= step]
            j = j[(cell[j - step] == cell[j]) & (100 * n[j - step] >= percent * n[j])]  # sizes ascend in a cell: no row further up fits either
            i = j - step
            good = (comp[i] != comp[j]) & ((lo[i] == hi[i]) | (salt[i] != salt[j]))
            x, y = i[good], j[good]
            good = _alike(sketches, n, x, y, percent)
            x, y = x[good], y[good]
            if not len(x):
                continue
            swap = comp[x] > comp[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            kept = np.concatenate([kept, np.stack([comp[x], comp[y], ids[x], ids[y], sign[x]], axis=1)])
            kept = kept[np.lexsort(kept.T[::-1])]
            pair, comps = _new(kept[:, :4]), _new(kept[:, :2])
            number = np.cumsum(pair)  # of different pairs
            place = number - number[np.flatnonzero(comps)[np.cumsum(comps) - 1]]
            left.append(np.unique(kept[place >= most, 4]))
            kept = kept[pair & (place < most)]
        pairs = np.sort(kept[:, 2:4], axis=1)
        yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})
        yield pd.DataFrame({"sign": np.unique(np.concatenate(left))})

    def both(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in run(frames):
            yield frame.reindex(columns=["a", "b", "sign"]).astype("Int64")

    return cells.repartition(parts, "sign", "lo", "hi").sortWithinPartitions(*order).mapInPandas(both, "a long, b long, sign long")


def _new(rows: np.ndarray) -> np.ndarray:
    """Whether a row of sorted rows differs from the one before."""
    return np.r_[True, np.any(rows[1:] != rows[:-1], axis=1)]


def similar_sets(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links of `percent` or more) of every row."""
    small_batches(docs.sparkSession)
    base = materialise(signed_sets(docs, words, percent), "signed")
    live = base.filter("n_shingles > 0 and doc_id is not null")
    classes = materialise(live.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    signed = base.filter("signatures is not null").withColumnRenamed("doc_id", "id")
    # The documents that stand for a class in different tasks, and all texts of one doc_id, are linked through their classes.
    copies = signed.select("id", "digest").join(classes.withColumnRenamed("id", "b"), "digest").filter("id != b").select(F.col("id").alias("a"), "b").distinct()
    near = first_pairs(signature_rows(signed.select("id", F.col("id").alias("comp"), F.col("first").alias("signatures"))), 2 * FIRST * base.count())
    labels = materialise(components(copies.union(_shared_ids(live, classes)).union(_confirmed(docs, signed, near, words, percent))), "labels")
    count = signed.agg(F.sum(F.octet_length("signatures") / 8).cast("long")).first()[0] or 0
    rows = materialise(mixed_buckets(signature_rows(with_components(signed, labels)), count).select("sign", "id"), "buckets")
    # A pair meets in many buckets, so a part of them merges most components before all are gone through.
    everything, rows, tested, most = rows, rows.filter(F.pmod("sign", F.lit(PART)) == 0), None, 1
    while True:
        narrow, n = counted(_dealt(rows, signed, labels), "cells")
        cells = narrow.join(signed.select("id", F.xxhash64("digest").alias("key"), "sketch"), ["id", "key"])
        found = materialise(bucket_pairs(cells, percent, most, max(partitions_of(docs.sparkSession), -(-n // CELL_ROWS))), "pairs")
        pairs, left = found.filter("a is not null").select("a", "b").distinct(), found.filter("sign is not null").select("sign").distinct()
        fresh = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        links = _confirmed(docs, signed, fresh, words, percent)
        if not links.isEmpty():  # earlier components stand for the links that made them
            labels = materialise(components(labels.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(links)), "labels")
        tested = pairs if tested is None else tested.union(fresh)
        if everything is not None:
            rows, everything = everything, None
            continue
        if left.isEmpty():
            break
        rows, most = rows.join(left, "sign", "left_semi"), MORE * most
    named = classes.join(labels, "id", "left").select("digest", F.coalesce("comp", "id").alias("comp"))
    joined = base.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest")).join(named, "digest", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"))


def _shared_ids(live: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one doc_id that has several texts."""
    several = live.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).filter("least != most").select("doc_id")
    return live.join(several, "doc_id").join(classes, "digest").filter("id != doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct()


def _dealt(rows: DataFrame, signed: DataFrame, labels: DataFrame) -> DataFrame:
    """sign, lo, hi, salt, id, key, comp, n of the buckets that hold several components, dealt over cells: each two rows of a bucket meet in exactly one."""
    sets = signed.select("id", F.xxhash64("digest").alias("key"), F.col("n_shingles").cast("int").alias("n")).distinct().join(rows.select("id").distinct(), "id", "left_semi")
    marked = rows.join(sets.join(labels, "id", "left").select("id", "key", "n", F.coalesce("comp", "id").alias("comp")), "id")
    lists = marked.groupBy("sign").agg(F.count("*").alias("rows"), F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least != most")
    salted = marked.join(lists.select("sign", F.ceil(F.col("rows") / minhash.BLOCK).cast("int").alias("blocks")), "sign").withColumn("salt", F.pmod(F.xxhash64("id", "sign"), "blocks").cast("int"))
    other = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("sign", F.least("salt", "other").alias("lo"), F.greatest("salt", "other").alias("hi"), "salt", "id", "key", "comp", "n")


def _confirmed(docs: DataFrame, signed: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; sketches go before, and only the texts of candidates are read."""
    bits = signed.select("id", "n_shingles", "bits")
    left, right = (bits.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in ("a", "b"))
    possible = pairs.distinct().join(left, "a").join(right, "b").filter(_possible("bits_a", "bits_b", "n_a", "n_b", F.lit(percent)))
    pairs = materialise(possible.select("a", "b").distinct(), "possible")
    if pairs.isEmpty():
        return pairs
    return materialise(confirm(pairs, materialise(_whole_sets(docs, candidate_filter(pairs), words), "sets"), percent), "links")


@F.pandas_udf(T.BooleanType())
def _possible(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series, percent: pd.Series) -> pd.Series:
    return pd.Series([least_differences(x, y) * (100 + p) <= (i + j) * (100 - p) for x, y, i, j, p in zip(a, b, n_a, n_b, percent)], dtype=bool)


def _whole_sets(docs: DataFrame, keep: bytes, words: int) -> DataFrame:
    """id and full set of every document that the filter of candidates lets through (others among them meet no pair); repeated rows give some rows a task."""
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(shared.value, np.uint64), set()
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = _slots(ids)
            hit = np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            rows, held = [], 0
            for at in hit.tolist():
                found = shingle_hashes(batch.column(1)[at].as_py(), words).tobytes()
                mark = (int(ids[at]), hashlib.blake2b(found, digest_size=16).digest())
                if mark not in seen:
                    seen.add(mark)
                    rows.append((mark[0], found))
                    held += len(found)
                if held > SLICE:
                    yield _set_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _set_batch(rows)
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "id long, shingles binary")


def _set_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.binary())], ["id", "shingles"])
