"""Hard negatives by product quantisation with stored residual norms.

Vectors come in as whole numbers floor(scale * x), and a score is an integer inner product. Every pair of components is a
subspace with a codebook of at most CODES whole points. A row holds a code for each subspace and the norm of its residual,
what its codes leave of it. A query makes one table of its products with every point of every codebook; the sum of the
looked-up products differs from the true score by at most the query's norm times the residual's norm. Both sides are whole
numbers or rounded outward, so this filter loses nothing, whatever the codebooks are:

- positives, the best rows of an anchor's label: the k-th largest lower bound is reached by k rows, so that only rows whose upper
  bound reaches it can be among the best k;
- negatives, the best rows of other labels in a window of scores: k rows whose upper bound lies under the window's upper end have their
  k-th largest lower bound as the least score of the window's best k.

What the filter lets through is scored exactly on the whole vectors, and the exact scores decide: results are exact, ties go to the
smaller id. Codebooks are fitted on at most SAMPLE_ROWS rows, the first by a hash of their id; they change the
time that a search takes and no result. A dimension without a sampled row has the zero vector as its only code.

Rows are dealt to shards by a hash of their id, SHARD_ROWS to a shard until there are MOST_SHARDS of them and more rows to a
shard after that, up to LARGE_ROWS, so that the copies of the queries don't outgrow the rows. Rows and queries of a shard come as one
sorted stream, rows first. Each shard gives a query its best k, and a ranked window with partial limits merges them. Scores of
positives are global before negatives are searched, in a second pass over the shards.

Rows with a null id or label, or a vector that is null, empty, or holds null or non-finite components take no part, nor do vectors
whose squares don't fit into a long (see vectors.MOST_SQUARES). Vectors of different dimensions do not meet. A row is no partner of its own
id. An id that comes with several labels or vectors stands for the least (label, vector); equal rows count once. A
window whose positive score is negative is empty. Anchors without positives or negatives give no row; neither does
an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import map_batches, settle, temporary
from wattframe.llm.vectors import MOST_SQUARES, matrix, products, scaled, squares

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
CODES, PART = 256, 2
#: Rows and rounds that the codebooks are fitted with, on the driver.
SAMPLE_ROWS, FIT_ROUNDS = 4096, 3
SHARD_ROWS, MOST_SHARDS, LARGE_ROWS = 8192, 256, 1 << 17
#: Sums of looked-up products that one step holds.
STEP = 1 << 20
#: By how much bounds are rounded outward.
SLACK = 1e-12


def _parts(x: np.ndarray) -> np.ndarray:
    """(subspaces, rows, PART); a last odd component has a zero beside it."""
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % PART)))
    return np.ascontiguousarray(x.reshape(len(x), -1, PART).transpose(1, 0, 2))


def fit_codebooks(sample: np.ndarray) -> np.ndarray:
    """(subspaces, codes, PART) whole points: k-means in each subspace, from the first distinct sampled parts."""
    books = []
    for part in _parts(sample):
        first = np.sort(np.unique(part, axis=0, return_index=True)[1])[:CODES]
        book = part[first]
        for _ in range(FIT_ROUNDS if len(first) == CODES else 0):
            near = squares(part, book).argmin(axis=1)
            n = np.bincount(near, minlength=len(book))
            sums = np.stack([np.bincount(near, weights=part[:, j], minlength=len(book)) for j in range(PART)], axis=1)
            book = np.where(n[:, None] > 0, np.rint(sums / np.maximum(n, 1)[:, None]), book).astype(np.int64)
        books.append(np.pad(book, ((0, CODES - len(book)), (0, 0)), mode="edge"))
    return np.stack(books)


def encode(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, subspaces) and residual norms, rounded up."""
    parts = _parts(x)
    codes = np.stack([squares(p, b).argmin(axis=1) for p, b in zip(parts, books, strict=True)], axis=1)
    rest = np.stack([p - b[c] for p, b, c in zip(parts, books, codes.T, strict=True)])
    return codes.astype(np.uint8), np.sqrt((rest.astype(float) ** 2).sum(axis=(0, 2))) * (1 + SLACK)


class Shard:
    """Rows of one dimension by label, their codes and residual norms."""

    def __init__(self, books: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, codes: np.ndarray, residuals: np.ndarray) -> None:
        order = np.lexsort((ids, labels))
        self.books, self.ids, self.labels, self.vectors, self.residuals = books, ids[order], labels[order], vectors[order], residuals[order]
        self.codes = np.ascontiguousarray(codes[order].T.astype(np.intp))
        #: Rows scored exactly so far.
        self.scored = 0

    def labelled(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right")))

    def bounds(self, queries: np.ndarray, rows: slice) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, lower, upper bounds of its scores with the rows), from looked-up products."""
        many = max(1, STEP // max(1, rows.stop - rows.start))
        for begin in range(0, len(queries), many):
            asked = queries[begin : begin + many]
            tables = [products(b, q) for b, q in zip(self.books, _parts(asked), strict=True)]
            small = sum(int(np.abs(t).max(initial=0)) for t in tables) < 2**31
            total = None
            for table, code in zip(tables, self.codes[:, rows], strict=True):
                found = np.take(table.astype(np.int32) if small else table, code, axis=0)
                if total is None:
                    total = found
                else:
                    total += found
            norms = np.sqrt((asked.astype(float) ** 2).sum(axis=1)) * (1 + SLACK)
            for k, sums in enumerate(np.ascontiguousarray(total.T).astype(float)):
                apart = self.residuals[rows] * norms[k] + SLACK * (np.abs(sums) + 1)
                yield begin + k, sums - apart, sums + apart

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        self.scored += len(rows)
        return products(self.vectors[rows], query[None, :])[:, 0]

    def positives(self, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
        """(anchor, id, score) of the best k rows with the anchor's label, for each anchor."""
        for label in np.unique(labels):
            asked = np.flatnonzero(labels == label)
            same = self.labelled(label)
            if same.start == same.stop:
                continue
            for n, low, high in self.bounds(queries[asked], same):
                anchor = asked[n]
                low[self.ids[same] == ids[anchor]] = high[self.ids[same] == ids[anchor]] = -np.inf
                least = max(np.partition(low, -k)[-k], -MOST_SQUARES * 4) if len(low) > k else -MOST_SQUARES * 4
                rows = same.start + np.flatnonzero(high >= least)
                score = self.exact(queries[anchor], rows)
                for i in np.lexsort((self.ids[rows], -score))[:k]:
                    yield ids[anchor], self.ids[rows[i]], score[i]

    def negatives(self, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, windows: list[list[tuple[int, int]]], k: int, share: tuple[int, int]) -> Iterator[tuple]:
        """(anchor, positive, its score, id, score) of the best k rows of other labels in the window of each positive."""
        for n, low, high in self.bounds(queries, slice(0, len(self.ids))):
            wanted = [(p, s, -(-share[0] * s // 100), share[1] * s // 100) for p, s in windows[n]]
            wanted = [w for w in wanted if w[2] <= w[3]]
            if not wanted:
                continue
            other = (high >= min(w[2] for w in wanted)) & (low <= max(w[3] for w in wanted))
            other[self.labelled(labels[n])] = False
            other = np.flatnonzero(other)
            low, high = low[other], high[other]
            chosen = []
            for _, _, least, most in wanted:
                sure = low[high <= most]
                reach = max(np.partition(sure, -k)[-k], least) if len(sure) >= k else least
                chosen.append((high >= reach) & (low <= most))
            any_of = np.logical_or.reduce(chosen)
            rows = other[any_of]
            score = self.exact(queries[n], rows)
            for (positive, of, least, most), inside in zip(wanted, chosen, strict=True):
                at = np.flatnonzero(inside[any_of] & (score >= least) & (score <= most))
                at = at[np.lexsort((self.ids[rows[at]], -score[at]))[:k]]
                for i in at:
                    yield ids[n], positive, of, self.ids[rows[i]], score[i]


def _run(books, find, schema: list[str]):
    """Streams of (shard, asks, id, label, vector, codes, residual, windows), rows before queries, to what find gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shard = None, [], None
        for batch in batches:
            keys, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                ids, labels, x = part.column(2).to_numpy(), part.column(3).to_numpy(), matrix(part.column(4))
                if keys[a] != current:
                    current, held, shard = keys[a], [], None
                if not asks[a]:
                    codes = np.stack([np.frombuffer(c, np.uint8) for c in part.column(5).to_pylist()])
                    held.append((ids, labels, x, codes, part.column(6).to_numpy()))
                    continue
                if shard is None and held:
                    shard, held = Shard(books.value.of_size(x.shape[1]), *map(np.concatenate, zip(*held, strict=True))), []
                if shard is not None:
                    rows = list(find(shard, ids, labels, x, part.column(7)))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=schema)

    return run


class Books:
    """Codebooks by dimension; one code, the zero vector, where a dimension has none."""

    def __init__(self, of: dict[int, np.ndarray]) -> None:
        self.of = of

    def of_size(self, dimension: int) -> np.ndarray:
        found = self.of.get(dimension)
        return np.zeros((-(-dimension // PART), CODES, PART), np.int64) if found is None else found


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = (LOW, HIGH), scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    For each row where is_anchor holds and each of its best `positives` rows of the same label: the best `negatives` rows of
    other labels whose score is between share[0] and share[1] percent of the positive's. The result is settled in the shared folder.
    """
    with temporary(vectors.sparkSession) as keep:
        return keep(settle(_mine(vectors, is_anchor, positives, negatives, share, scale, id_col, vector_col, label_col), "negatives"))


def _mine(vectors: DataFrame, is_anchor: Column, positives: int, negatives: int, share: tuple[int, int], scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled(F.col(vector_col), scale).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.filter("id is not null and label is not null and vector is not null")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector", "asks")).alias("row")).select("id", "row.*")
    rows = settle(rows, "whole")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vector").collect()
    parts: dict[int, list] = {}
    for r in sample:
        parts.setdefault(len(r.vector), []).append(r.vector)
    books = spark.sparkContext.broadcast(Books({n: fit_codebooks(np.array(x, dtype=np.int64)) for n, x in parts.items()}))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column(2).offsets.to_numpy())
            codes, residuals = np.empty(len(size), dtype=object), np.zeros(len(size))
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                found, residuals[at] = encode(matrix(batch.column(2).take(pa.array(at))), books.value.of_size(int(n)))
                for i, c in zip(at, found, strict=True):
                    codes[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(residuals)], names=[*batch.schema.names, "codes", "residual"])

    # A row for each dimension comes to the driver.
    seen = rows.groupBy(F.size("vector").alias("dimension")).count().orderBy("dimension").collect()
    many = [max(min(-(-r["count"] // SHARD_ROWS), MOST_SHARDS), -(-r["count"] // LARGE_ROWS)) for r in seen]
    dealt = spark.createDataFrame([(r.dimension, sum(many[:k]), many[k]) for k, r in enumerate(seen)], "dimension int, first int, many int")
    encoded = map_batches(rows.select("id", "label", "vector", "asks"), coded, "id long, label long, vector array<int>, asks boolean, codes binary, residual double")
    encoded = settle(encoded.withColumn("dimension", F.size("vector")).join(F.broadcast(dealt), "dimension"), "encoded")
    shard = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("many"))).cast("int")
    none = F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("windows")
    held = encoded.select(shard.alias("shard"), F.lit(False).alias("asks"), "id", "label", "vector", "codes", "residual", none)

    def stream(asked: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("many") - 1)).alias("shard")
        asked = asked.select(every, F.lit(True).alias("asks"), "id", "label", "vector", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("residual"), "windows")
        return held.union(asked).repartition("shard").sortWithinPartitions("shard", "asks")

    def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", place).filter(F.col("rank") <= k)

    anchors = encoded.filter("asks").select("id", "label", "vector", "first", "many")
    first = ["anchor_id", "id", "score"]
    found = map_batches(stream(anchors.withColumn("windows", none)), _run_positives(books, positives, first), ", ".join(f"{c} long" for c in first))
    windows = best(found, ["anchor_id"], positives).groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("id", "score"))).alias("windows"))
    windows = settle(windows, "windows")
    second = ["anchor_id", "positive_id", "positive_score", "id", "score"]
    asked = anchors.join(windows, anchors.id == windows.anchor_id).drop("anchor_id")
    found = map_batches(stream(asked), _run_negatives(books, negatives, share, second), ", ".join(f"{c} long" for c in second))
    out = best(found, ["anchor_id", "positive_id"], negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _run_positives(books, k: int, schema: list[str]):
    return _run(books, lambda shard, ids, labels, x, _: shard.positives(ids, labels, x, k), schema)


def _run_negatives(books, k: int, share: tuple[int, int], schema: list[str]):
    def find(shard: Shard, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, windows: pa.Array) -> Iterator[tuple]:
        return shard.negatives(ids, labels, x, [[(w["id"], w["score"]) for w in each] for each in windows.to_pylist()], k, share)

    return _run(books, find, schema)
