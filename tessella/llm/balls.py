"""Ball k-means over vectors of whole numbers, exact.

A cluster is a ball: its centroid and a radius that holds all its vectors. Moving a centroid by s makes the radius at most s larger, so the new balls follow from the
last round's aggregate (count, sums and greatest distance of each cluster) without another pass. A centroid is a neighbour of a ball where half its distance to the ball's
centre is not beyond the radius. Neighbours are sorted by distance: a vector nearer to its centroid than half the way to the nearest neighbour lies in the stable core and
stays; the annulus between the k-th and the next half way is compared with the nearest k neighbours exactly. All bounds are in whole numbers, so that ties go to the
smaller number and no rounding moves a vector.

Each round writes the vectors with their cluster and distance to the shared folder and aggregates what it wrote; a row for each cluster reaches the driver (k of them).

Defined cases: vectors that are null, of another length, or with null or non-finite components are left out; fewer vectors than k give as many clusters as vectors; none give
an empty result. Vectors that share a vec_id are vectors of their own; where they tie for a first centroid, or have no vec_id (which comes last), the components decide. A
component beyond 2^27 in size after scaling fails, since squared distances would not fit a long. Only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import local_table, materialise

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
MOST = 1 << 27  # size of a scaled component

STATE = "vec_id long, x array<int>, cluster int, distance long"


def whole_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and x: the usable vectors, every component times scale, rounded down."""
    fits = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    usable = usable.filter((F.size("e") == dimensions) & F.forall("e", fits))
    # A filter may run after the projection that it guards, so the whole numbers are made under the condition.
    small = F.forall("e", lambda v: F.abs(v * scale) < MOST)
    x = F.when(small, F.transform("e", lambda v: F.floor(v * scale).cast("int")))
    return usable.select("vec_id", F.coalesce(x, F.raise_error(F.lit("vector component too large")).cast("array<int>")).alias("x"))


def first_centroids(vectors: DataFrame, k: int) -> list[list[int]]:
    """The k vectors of smallest sha256 of `1:<vec_id>`, in that order."""
    place = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    return [list(r["x"]) for r in vectors.orderBy(place.asc_nulls_last(), "x").limit(k).collect()]


class Balls:
    """Centroids, and for every ball its neighbour centroids, nearest first, with the squared distance at which each begins to matter (4 * d >= D)."""

    def __init__(self, centroids: list[list[int]], radii: list[int] | None = None):
        self.centroids = np.array(centroids, np.int64)
        apart = ((self.centroids[:, None, :] - self.centroids[None, :, :]) ** 2).sum(axis=2)
        self.neighbours: list[tuple[np.ndarray, np.ndarray]] = []
        for c, row in enumerate(apart.tolist()):
            near = [(d, j) for j, d in enumerate(row) if j != c and (radii is None or d <= 4 * radii[c] ** 2)]
            near.sort()
            self.neighbours.append((np.array([j for _, j in near], np.int64), np.array([-(-d // 4) for d, _ in near], np.int64)))

    def assign(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of every vector and the squared distance, from the balls that the vectors are in."""
        best, least = own.copy(), np.empty(len(x), np.int64)
        for c in np.unique(own):
            members = np.flatnonzero(own == c)
            least[members] = d = ((x[members] - self.centroids[c]) ** 2).sum(axis=1)
            numbers, begins = self.neighbours[c]
            annulus = np.searchsorted(begins, d, side="right")  # 0: the stable core
            for k in range(int(annulus.max(initial=0))):
                outer = members[annulus > k]
                j = int(numbers[k])
                other = ((x[outer] - self.centroids[j]) ** 2).sum(axis=1)
                nearer = (other < least[outer]) | ((other == least[outer]) & (j < best[outer]))
                best[outer[nearer]], least[outer[nearer]] = j, other[nearer]
        return best, least


def assigned(vectors: DataFrame, balls: Balls) -> DataFrame:
    """Vectors (vec_id, x, and the cluster they were in) with their nearest centroid; k centroids go along with the function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = balls.centroids.shape[1]
        for batch in batches:
            x = batch.column(1)
            own = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            cluster, distance = balls.assign(x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width), own)
            yield pa.RecordBatch.from_arrays([batch.column(0), x, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "x", "cluster", "distance"])

    return vectors.select("vec_id", "x", "cluster").mapInArrow(run, STATE)


def _moved(state: DataFrame, centroids: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """The next centroids and radii that hold their balls."""
    width = len(centroids[0])
    totals = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("distance").alias("far"), F.array(*[F.sum(F.col("x")[i].cast("long")) for i in range(width)]).alias("sums"))
    found = {r["cluster"]: r for r in totals.collect()}
    out, radii = [], []
    for c, old in enumerate(centroids):
        row = found.get(c)
        new = [s // row["n"] for s in row["sums"]] if row else old
        shift = sum((a - b) ** 2 for a, b in zip(new, old))
        out.append(new)
        radii.append(isqrt(row["far"]) + 1 + isqrt(shift) + 1 if row else 0)
    return out, radii


def ball_kmeans(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector after `rounds` rounds and a last assignment."""
    spark = embeddings.sparkSession
    vectors = materialise(whole_vectors(embeddings, dimensions, scale), "vectors")
    centroids = first_centroids(vectors, k)
    if not centroids:
        return vectors.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    # Before the first round all vectors are in the ball of the first centroid, of any radius.
    state, radii = vectors.withColumn("cluster", F.lit(0)), None
    for _ in range(rounds):
        state = materialise(assigned(state, Balls(centroids, radii)), "balls")
        centroids, radii = _moved(state, centroids)
    state = materialise(assigned(state, Balls(centroids, radii)), "balls")
    sums = dict(map(tuple, state.groupBy("cluster").agg(F.sum("distance")).collect()))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, sums.get(c, 0), sum(sums.values()), digests[c]) for c in range(len(centroids))]
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(local_table(spark, rows, schema)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
