"""Approximate nearest neighbours by a hash-prefix forest.

A row's string in each of TREES trees is BITS signs of random projections (orthogonal within runs of the dimension).
A tree is the sorted array of its rows' strings: a query descends to its longest-prefix match, and then all trees
ascend together, one bit at a time, until the rows that share a prefix of that length with the query in any tree
are as many as the target. These candidates are scored exactly, in double precision, on the original vectors.

Inner products become angles by one more coordinate, sqrt(largest norm^2 - norm^2), that queries have as zero; where
all norms are equal it changes nothing. Large, it would drown the others in the signs: so a shard holds one range of
norms, of which the largest is at most NORM_STEP times the least, and takes the largest norm of its own.

Spark deals the rows of a range out to shards of about SHARD_ROWS by a hash of id and vector, so that equal or close
vectors, however many, spread evenly. A row goes to one shard and a shard's forest is built once: rows and queries of a
shard come as one sorted stream, rows first, then the queries in Arrow batches of bounded size. Each shard gives every
query its best k, and a ranked window with partial limits merges them. A shard's target is SHARE of its rows whatever
its size. SHARE is high because vectors without structure need it: for random directions in 64 dimensions the 20
nearest of 10,000 have cosines of 0.37, which few prefix bits keep. Forests over all rows, partitioned by prefix, would have to
shuffle each query's candidates one by one, and at this share these are nearly half of all pairs; a shard scores its own in place.

Vectors that are null, empty, zero or hold null or non-finite components take no part, as do null ids. Queries and
rows of different dimensions do not meet. A row of a query's own id is no candidate of it. Ties go to the smaller id.
Rows that repeat id and vector count once. An id with other vectors too stands for the one that scores best: it has one
rank in a query's result, and a query with several vectors keeps the best of all of them. Without valid rows the result is
empty. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import map_batches

TREES, BITS = 64, 32
SHARD_ROWS = 4096
#: Share of a shard's rows that a query's candidates should reach.
SHARE = 0.55
NORM_STEP = 1.05
SEED = 17


def projections(dimension: int) -> np.ndarray:
    """TREES * BITS directions; each run of `dimension` of them is orthogonal."""
    rng = np.random.default_rng(SEED)
    runs = [np.linalg.qr(rng.normal(size=(dimension, dimension)))[0] for _ in range(-(-TREES * BITS // dimension))]
    return np.concatenate(runs, axis=1)[:, : TREES * BITS]


def strings(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The hash strings of each vector, as unsigned integers (trees, rows); the first bit is the highest."""
    bits = np.packbits(((vectors @ directions) > 0).reshape(len(vectors) * TREES, BITS), axis=1)
    return np.ascontiguousarray(bits.view(">u4").reshape(len(vectors), TREES).T.astype(np.uint32))


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.order = np.argsort(hashes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashes, self.order, axis=1)
        self.rows = hashes.shape[1]

    def longest(self, queries: np.ndarray) -> np.ndarray:
        """The longest prefix length that any tree matches, for each query."""
        best = np.zeros(queries.shape[1], dtype=np.int64)
        for tree in range(TREES):
            at = np.searchsorted(self.sorted[tree], queries[tree])
            for near in (np.maximum(at - 1, 0), np.minimum(at, self.rows - 1)):
                apart = self.sorted[tree][near] ^ queries[tree]
                np.maximum(best, BITS - np.frexp(apart.astype(np.float64))[1], out=best)
        return best

    def ranges(self, queries: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each tree and query: the sorted rows that share the first `length` bits."""
        low, high = np.empty(queries.shape, np.int64), np.empty(queries.shape, np.int64)
        rest = (np.uint64(1) << (BITS - length).astype(np.uint64)) - np.uint64(1)
        rest = rest.astype(np.uint32)
        for tree in range(TREES):
            low[tree] = np.searchsorted(self.sorted[tree], queries[tree] & ~rest, side="left")
            high[tree] = np.searchsorted(self.sorted[tree], queries[tree] | rest, side="right")
        return low, high

    def candidates(self, queries: np.ndarray, target: int):
        """Yields (query, rows): synchronous ascent until `target` distinct rows are met, or all rows."""
        length = self.longest(queries)
        todo = np.arange(queries.shape[1])
        target = min(target, self.rows)
        while len(todo):
            low, high = self.ranges(queries[:, todo], length[todo])
            full = (high - low).sum(axis=0) >= target
            done = np.zeros(len(todo), dtype=bool)
            for k in np.flatnonzero(full | (length[todo] == 0)):
                size = high[:, k] - low[:, k]
                begin = np.cumsum(size) - size
                tree = np.repeat(np.arange(TREES), size)
                met = np.zeros(self.rows, dtype=bool)
                met[self.order[tree, np.arange(len(tree)) + np.repeat(low[:, k] - begin, size)]] = True
                rows = np.flatnonzero(met)
                if len(rows) >= target or length[todo[k]] == 0:
                    done[k] = True
                    yield todo[k], rows
            todo = todo[~done]
            length[todo] -= 1


def _valid(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Shard:
    """Rows of one dimension and one range of norms, and their forest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        squares = (vectors * vectors).sum(axis=1)
        gap = np.sqrt(np.maximum(squares.max() - squares, 0))
        self.wider = bool((gap > 1e-3 * np.sqrt(squares.max())).any())
        wide = np.c_[vectors, gap] if self.wider else vectors
        self.directions = projections(wide.shape[1])
        self.forest = Forest(strings(wide, self.directions))
        self.repeats = len(np.unique(ids)) < len(ids)
        #: Rows scored so far.
        self.scored = 0

    def search(self, asking: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, ids and scores of the k best found for each query, its own id left out."""
        wide = np.c_[queries, np.zeros(len(queries))] if self.wider else queries
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for n, near in self.forest.candidates(strings(wide, self.directions), math.ceil(SHARE * len(self.ids))):
            self.scored += len(near)
            near = near[self.ids[near] != asking[n]]
            score = self.vectors[near] @ queries[n]
            if len(near) > k and not self.repeats:
                cut = np.partition(score, -k)[-k]
                near, score = near[score >= cut], score[score >= cut]
            best = np.lexsort((self.ids[near], -score))
            if self.repeats:
                best = best[np.sort(np.unique(self.ids[near[best]], return_index=True)[1])]
            best = best[:k]
            out.append((np.full(len(best), asking[n]), self.ids[near[best]], score[best]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _search(k: int):
    """Streams of (shard, asks, id, vector), by shard and rows before queries, to (query_id, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shard = None, [], None
        for batch in batches:
            keys, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
                if a == b:
                    continue
                part = (batch.column(2).slice(a, b - a).to_numpy(), _matrix(batch.column(3).slice(a, b - a)))
                if keys[a] != current:
                    current, held, shard = keys[a], [], None
                if not asks[a]:
                    held.append(part)
                    continue
                if shard is None and held:
                    shard, held = Shard(*map(np.concatenate, zip(*held, strict=True))), []
                if shard is not None:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, shard.search(*part, k))), names=["query_id", "id", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id_col, score: the k largest inner products found for each row where is_query holds."""
    rows = vectors.filter(F.col(id_col).isNotNull()).withColumn("__query", is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), "__query")
    rows = rows.filter(_valid(F.col("vector"))).dropDuplicates(["id", "vector"]).withColumn("dimension", F.size("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    # Norm 1 lies in the middle of a range; squares that under- or overflow go to the outermost ones.
    step = F.round(F.log(F.least(F.greatest(norm, F.lit(1e-300)), F.lit(1e300))) / (2 * math.log(NORM_STEP))).cast("int")
    rows = rows.withColumn("range", step)
    # A row for each dimension and range: their number is bounded by the exponents of doubles, not by the rows.
    seen = rows.groupBy("dimension", "range").agg(F.count("*").alias("rows")).orderBy("dimension", "range").collect()
    many = [-(-r.rows // SHARD_ROWS) for r in seen]
    ranges = vectors.sparkSession.createDataFrame([(r.dimension, r.range, sum(many[:n]), many[n]) for n, r in enumerate(seen)], "dimension int, range int, first int, many int")
    own = (F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("many"))).cast("int")
    held = rows.join(F.broadcast(ranges), ["dimension", "range"]).select(own.alias("shard"), F.lit(False).alias("asks"), "id", "vector")
    every = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("many") - 1))
    asked = rows.filter("__query").select("id", "vector", "dimension").join(F.broadcast(ranges), "dimension").select(every.alias("shard"), F.lit(True).alias("asks"), "id", "vector")
    stream = held.union(asked).repartition("shard").sortWithinPartitions("shard", "asks")
    found = map_batches(stream, _search(k), "query_id long, id long, score double")
    # By query alone, so that the ranking needs no second shuffle.
    best = found.repartition("query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
