"""Periodic runs of words: a harmonic grid of longest common extensions.

A run of period p and of 4 * p words or more covers four neighbouring points of the grid 0, p, 2p, ... For every p the grid's points jp and (j+1)p are compared:
the longest common extension forward from them and backward before them tells the whole stretch of period p around them. An extension is the minimum of the
LCP array between two suffixes (suffix array, sparse table of range minima); backward ones come from the reversed text's array. Points of which the first four
words of the grid differ have no run, so their extension is not asked for, and a text without any such point needs no arrays. The grid has n * ln(n) points.

A stretch found under a multiple of its period has the same ends under its smallest period, which stays.

Each text is one row's work in an Arrow batch; nothing is shuffled. Memory is some n * log2(n) * 8 bytes for a text of n words that has candidates.

Defined cases: null and empty texts and texts without words have no runs, four nulls and the digests of the empty string; a null doc_id is never edited;
repeated rows each give a row; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LEAST_LENGTH = 6
REPEATS = 4  # periods that a run has at least
QUERIES = 1 << 20  # extensions asked for at once
SMALL = 4096  # texts up to so many words take the grid's points from one table

SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Extensions:
    """Longest common extensions of two places of a sequence of numbers: suffix array by doubling, LCP array, range minima."""

    def __init__(self, w: np.ndarray):
        n = self.n = len(w)
        ranks = [np.unique(w, return_inverse=True)[1].astype(np.int64)]
        order = np.argsort(ranks[0], kind="stable")
        while int(ranks[-1].max(initial=0)) + 1 < n:
            r, step = ranks[-1], 1 << (len(ranks) - 1)
            second = np.zeros(n, np.int64)
            second[: n - step] = r[step:] + 1
            key = r * (n + 1) + second
            order = np.argsort(key, kind="stable")
            new = np.cumsum(np.r_[False, np.diff(key[order]) != 0])
            r = np.empty(n, np.int64)
            r[order] = new
            ranks.append(r)
        self.rank = ranks[-1]
        # Neighbours in the suffix array: words of 2^k that agree, from the longest blocks down.
        x, y, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            inside = (x < n) & (y < n)
            same = inside.copy()
            same[inside] = ranks[k][x[inside]] == ranks[k][y[inside]]
            if k:  # a rank of 2^k words is of fewer where the text ends
                same &= np.maximum(x, y) + (1 << k) <= n
            x[same] += 1 << k
            y[same] += 1 << k
            lcp[same] += 1 << k
        self.minima = [lcp.astype(np.int32)]
        while len(self.minima[-1]) > 1 << (len(self.minima) - 1):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j on (i != j); none past the end."""
        out = np.zeros(len(i), np.int64)
        inside = np.flatnonzero((i < self.n) & (j < self.n) & (i >= 0) & (j >= 0))
        a, b = self.rank[i[inside]], self.rank[j[inside]]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        found = np.empty(len(inside), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            found[at] = np.minimum(row[a[at]], row[b[at] - (1 << int(k))])
        out[inside] = found
        return out


@lru_cache(1)
def _grid_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points g and periods p of the grids, by the last of the four words that they compare."""
    g = np.concatenate([np.arange(0, SMALL, p) for p in range(1, SMALL // REPEATS + 1)])
    p = np.repeat(np.arange(1, SMALL // REPEATS + 1), [len(range(0, SMALL, p)) for p in range(1, SMALL // REPEATS + 1)])
    last = g + (REPEATS - 1) * p
    order = np.argsort(last, kind="stable")
    order = order[last[order] < SMALL]
    return g[order].astype(np.int32), p[order].astype(np.int32), last[order]


def _agreeing(w: np.ndarray, g: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The points at which four neighbouring words of the grid agree."""
    for k in range(1, REPEATS):
        at = np.flatnonzero(w[g] == w[g + k * p])
        g, p = g[at], p[at]
    return g, p


def grid_points(w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Points and periods that can lie in a run, in pieces."""
    n = len(w)
    if n < LEAST_LENGTH:
        return
    if n <= SMALL:
        g, p, last = _grid_table()
        end = int(np.searchsorted(last, n))
        yield _agreeing(w, g[:end], p[:end])
        return
    root, most = int(n**0.5), n // REPEATS
    for p in range(1, min(root, most) + 1):  # many points a period
        g = np.arange(0, n - (REPEATS - 1) * p, p)
        for at in range(0, len(g), QUERIES):
            part = g[at : at + QUERIES]
            yield _agreeing(w, part, np.full(len(part), p))
    for j in range(n // (root + 1) + 1):  # the j-th points of the larger periods
        p = np.arange(root + 1, min(most, (n - 1) // (j + REPEATS - 1)) + 1)
        if len(p):
            yield _agreeing(w, j * p, p)


def runs(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start and period."""
    n, found, forward, backward = len(w), [], None, None
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def ask() -> None:
        nonlocal forward, backward
        if not held:
            return
        g, p = (np.concatenate(x).astype(np.int64) for x in zip(*held))
        held.clear()
        if forward is None:
            forward, backward = Extensions(w), Extensions(w[::-1])
        for at in range(0, len(g), QUERIES):
            i, q = g[at : at + QUERIES], p[at : at + QUERIES]
            f, b = forward(i, i + q), backward(n - i, n - i - q)
            length = q + f + b
            keep = length >= np.maximum(LEAST_LENGTH, REPEATS * q)
            rows = np.unique(np.stack([(i - b)[keep], length[keep], q[keep]], axis=1), axis=0)
            found.append(rows)
        if len(found) > 1:
            found[:] = [np.unique(np.concatenate(found), axis=0)]

    waiting = 0
    for g, p in grid_points(w):
        if len(g):
            held.append((g, p))
            waiting += len(g)
            if waiting > QUERIES:
                ask()
                waiting = 0
    ask()
    if not found or not len(found[0]):
        return []
    rows = found[0]  # by start, length, period: the first of equal ends has the smallest period
    first = np.r_[True, np.any(rows[1:, :2] != rows[:-1, :2], axis=1)]
    return sorted(((s, n_, q) for s, n_, q in rows[first].tolist()), key=lambda r: (r[0], r[2]))


def edited(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document; one in ten ids has its tail made periodic."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def describe(words: list[bytes]) -> tuple:
    """n_runs, the run of greatest exponent and the digests of the runs and of the words that stay."""
    ids: dict[bytes, int] = defaultdict(count().__next__)
    found = runs(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
    text = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
    if not found:
        return 0, None, None, None, None, text, hashlib.sha256(b" ".join(words)).hexdigest()
    over = np.zeros(len(words) + 1, np.int64)
    for s, n, p in found:
        over[s + p] += 1
        over[s + n] -= 1
    kept = np.flatnonzero(np.cumsum(over)[:-1] == 0)
    s, n, p = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return len(found), s, n, p, 1000 * n // p, text, hashlib.sha256(b" ".join([words[k] for k in kept])).hexdigest()


def periodic_runs(docs: DataFrame) -> DataFrame:
    """For every document the number of its periodic runs, the strongest, and digests of all runs and of the text without their repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = WORD.findall((text.as_py() or "").encode("utf-8", "surrogatepass"))
                rows.append((doc_id, *describe(edited(words, doc_id))))
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
