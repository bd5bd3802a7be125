"""Centroid clustering by exponion search, in exact integers.

Each vector carries its cluster, an upper bound of the distance to its centroid and a lower bound of the distance to
every other one. When centroids move, the bounds move with them. A vector whose upper bound stays under the lower one,
or under half the distance from its centroid to the next, keeps its cluster without a look at any centroid. Otherwise
the upper bound becomes the true distance u, and if that doesn't settle it, the centroids inside the ball around its
own centroid of radius 2u + s are scanned, s being the distance to that centroid's nearest other: these hold the
nearest and the second nearest. For every centroid the others stand in a list sorted by distance, so that a ball is a prefix of it. The
radius is inclusive and vectors are skipped on strict inequalities alone, so ties are always seen and go to the smaller number.

Spark runs one pass of the rows a round, in Arrow batches, without a shuffle; each round's rows are settled in the shared
folder. Only the centroids, as many sums and counts, come to the driver. Squared distances are exact; bounds are doubles
rounded outward.

Vectors that are null, of another size, or hold null or non-finite components take no part, nor do those whose squares
don't fit into a long (see vectors.MOST_SQUARES). Vectors come in as whole numbers floor(scale * x). Rows that repeat an
id count each; starting rows with equal ids come in the order of their vectors. A null id starts a cluster only where
others don't suffice. With fewer rows than clusters there are as many clusters as rows; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import discard, map_batches, settle
from wattframe.llm.vectors import matrix, scaled, squares

CLUSTERS, ROUNDS, SCALE, SIZE, SEED = 16, 3, 64, 64, 1
#: By how much bounds are rounded outward.
SLACK = 1e-12


class Exponion:
    """The centroids of one round, with the sorted list of the others for each."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None) -> None:
        """before: the centroids of the round before, that the bounds were made for."""
        self.centroids = centroids
        gaps = np.sqrt(squares(centroids, centroids).astype(float))
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        np.fill_diagonal(gaps, np.inf)
        #: Distance from each centroid to its nearest other.
        self.near = gaps.min(axis=1, initial=np.inf)
        moved = np.zeros(len(centroids)) if before is None else np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(float)) * (1 + SLACK)
        self.moved = moved
        most = np.argmax(moved) if len(moved) else 0
        rest = np.delete(moved, most).max(initial=0)
        #: The farthest move of any other centroid.
        self.others = np.where(np.arange(len(moved)) == most, rest, moved.max(initial=0))
        #: Distances computed to centroids so far.
        self.scanned = 0

    def assign(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Clusters and bounds of the rows of x, from those of the round before."""
        cluster = cluster.copy()
        upper = (upper + self.moved[cluster]) * (1 + SLACK)
        lower = lower - self.others[cluster] - SLACK * (lower + self.others[cluster])
        safe = np.maximum(lower, self.near[cluster] / 2 * (1 - SLACK))
        todo = np.flatnonzero(upper >= safe)
        for a in np.unique(cluster[todo]):
            rows = todo[cluster[todo] == a]
            upper[rows] = np.sqrt(squares(x[rows], self.centroids[a : a + 1])[:, 0].astype(float)) * (1 + SLACK)
            self.scanned += len(rows)
            rows = rows[upper[rows] >= safe[rows]]
            ball = (2 * upper[rows] + self.near[a]) * (1 + SLACK)
            reach = np.searchsorted(self.gaps[a], ball, side="right")
            for n in np.unique(reach):
                self.scan(x, rows[reach == n], np.sort(self.order[a, :n]), cluster, upper, lower)
        return cluster, upper, lower

    def scan(self, x: np.ndarray, rows: np.ndarray, among: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        """Nearest and second nearest of the centroids `among`, in ascending order of their numbers."""
        found = squares(x[rows], self.centroids[among])
        self.scanned += found.size
        best = found.argmin(axis=1)
        cluster[rows] = among[best]
        upper[rows] = np.sqrt(found[np.arange(len(rows)), best].astype(float)) * (1 + SLACK)
        lower[rows] = np.sqrt(np.partition(found, 1, axis=1)[:, 1].astype(float)) * (1 - SLACK) if len(among) > 1 else np.inf


def _pass(rows: DataFrame, centroids: np.ndarray, before: np.ndarray | None, last: bool) -> DataFrame:
    """One assignment of all rows; the last one gives distances instead of vectors and bounds."""
    sent = rows.sparkSession.sparkContext.broadcast((centroids, before))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Exponion(*sent.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            cluster, upper, lower = search.assign(x, *(batch.column(k).to_numpy() for k in (2, 3, 4)))
            if last:
                distance = np.zeros(len(x), dtype=np.int64)
                for c in np.unique(cluster):
                    distance[cluster == c] = squares(x[cluster == c], search.centroids[c : c + 1])[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(distance)], names=["id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster), pa.array(upper), pa.array(lower)], names=names)

    return map_batches(rows, run, "id long, cluster int, distance long" if last else rows.schema)


def _means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the exact means; clusters without rows stay."""
    size = centroids.shape[1]
    sums = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*[F.sum(F.col("vector")[k]) for k in range(size)]).alias("sums")).collect()
    out = centroids.copy()
    for r in sums:
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


@dataclass
class Clusters:
    """rows: id, cluster, distance (squared); centroids: a row of whole numbers for each cluster."""

    rows: DataFrame
    centroids: np.ndarray


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, size: int = SIZE, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    """Clusters of all rows with a whole vector. They start from the rows with the least SHA-256 of "seed:id"."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale, size).alias("vector")).filter("vector is not null")
    drawn = F.coalesce(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), F.lit("~"))
    start = rows.orderBy(drawn, "vector").limit(clusters).collect()
    if not start:
        return Clusters(rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, size), np.int64))
    centroids, before = np.array([r.vector for r in start], dtype=np.int64), None
    # Nothing is known yet: the first pass measures the distance to the first centroid and scans the ball that follows from it.
    state = rows.withColumns({"cluster": F.lit(0), "upper": F.lit(float("inf")), "lower": F.lit(0.0)})
    used = None
    for _ in range(rounds):
        state = settle(_pass(state, centroids, before, False), "assigned")
        if used is not None:
            discard(used)
        used = state
        centroids, before = _means(state, centroids), centroids
    done = settle(_pass(state, centroids, before, True), "clusters")
    if used is not None:
        discard(used)
    return Clusters(done, centroids)


def digests(found: Clusters, id_col: str = "vec_id") -> DataFrame:
    """The contract's columns. Only one row for each cluster is broadcast."""
    spark = found.rows.sparkSession
    inertia = {r.cluster: int(r.inertia) for r in found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    written = [(k, inertia.get(k, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(found.centroids.tolist())]
    each = spark.createDataFrame(written, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.withColumnRenamed("id", id_col).join(F.broadcast(each), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
