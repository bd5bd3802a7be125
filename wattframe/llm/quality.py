"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts, vectorised over bytes and words of many documents at once. Training takes at most
TRAIN_ROWS labelled rows, the first by a hash of their id (a documented bound on a sample; the statistics of these rows
alone go to the driver). Trees are flattened into arrays of a full binary tree, so scoring descends all trees of all
rows of a batch level by level in numpy.

Null and empty texts have statistics of zeros and get a score as any other. Very long texts count whole. Repeated rows
get a row each. Without labels the score is 0.5; with one class only it is that class's smoothed share. Labels with a
null id or label take no part; labels that repeat for an id count each time. Which labelled rows are learned from, and the
least leaf size that an inner split of them picks, don't depend on the order or the partitions of the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from wattframe.llm.common import LOWER, hash_words, map_batches, text_steps, words_of

#: Most labelled rows in training.
TRAIN_ROWS = 20_000
ROUNDS, DEPTH, BINS, RATE, RIDGE = 120, 4, 64, 0.12, 1.0
#: Least leaf sizes to choose from, and the rounds that the choice takes: the loss on every fourth training row decides.
LEASTS, CHOICE_ROUNDS = (5, 10, 20, 40), 30
THRESHOLD = 0.3

_SPACES = [9, 10, 11, 12, 13, 32]
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[_SPACES] = False
#: Kinds of bytes: 0 space, 1 line feed, 2 lower, 3 upper, 4 digit, 5 sentence mark, 6 quote or bracket, 7 exclamation or question, 8 bar, 9 other ASCII mark, 10 beyond ASCII, 11 control.
KIND = np.full(256, 11, dtype=np.uint8)
KIND[33:127] = 9
KIND[128:] = 10
KIND[_SPACES] = 0
KIND[10] = 1
KIND[97:123], KIND[65:91], KIND[48:58] = 2, 3, 4
KIND[[ord(c) for c in ".,;:-"]] = 5
KIND[[ord(c) for c in "\"'()[]{}"]] = 6
KIND[[ord(c) for c in "!?"]] = 7
KIND[ord("|")] = 8
KINDS = 12
FEATURES = [f"kind_{k}" for k in range(KINDS)] + ["log_bytes", "log_words", "word_mean", "word_sd", "word_max", "short_words", "upper_words", "marked_words", "only_marks", "distinct_words", "top_word", "lines", "line_words", "repeated_lines", "ended_lines", "entropy"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    rows, out = len(offsets) - 1, np.zeros((len(offsets) - 1, len(FEATURES)))
    sizes = np.diff(offsets)
    if not len(data):
        return out
    row = np.repeat(np.arange(rows, dtype=np.int32), sizes)
    kinds = np.bincount(row * KINDS + KIND[data], minlength=rows * KINDS).reshape(rows, KINDS)
    out[:, :KINDS] = kinds / np.maximum(sizes, 1)[:, None]
    starts, ends, counts = words_of(data, offsets, IS_WORD)
    n = np.maximum(counts, 1)
    begin = np.cumsum(counts) - counts
    has = counts > 0

    def total(x: np.ndarray) -> np.ndarray:
        s = np.zeros(rows)
        if has.any():
            s[has] = np.add.reduceat(x.astype(float), begin[has])
        return s

    long = ends - starts
    first, last = KIND[data[starts]], KIND[data[ends - 1]]
    second = KIND[data[np.minimum(starts + 1, ends - 1)]]
    mean = total(long) / n
    hashes = hash_words(LOWER[data], starts, ends)
    lines, line_row = _lines(data, offsets)
    line_count = np.bincount(line_row, minlength=rows)
    top, distinct, again = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    line_begin = np.cumsum(line_count) - line_count
    for r in range(rows):
        if counts[r]:
            runs = _runs(hashes[begin[r] : begin[r] + counts[r]])
            distinct[r], top[r] = len(runs), runs.max()
            again[r] = line_count[r] - len(_runs(lines[0][line_begin[r] : line_begin[r] + line_count[r]])) if line_count[r] else 0
    share = kinds / np.maximum(sizes, 1)[:, None]
    out[:, KINDS:] = np.stack([
        np.log1p(sizes), np.log1p(counts), mean, np.sqrt(np.maximum(total(long * long) / n - mean**2, 0)), _most(long, begin, has, rows), total(long <= 3) / n,
        total((first == 3) & (second == 3)) / n, total((last == 7) | (last == 8) | (last == 9)) / n, total((first >= 5) & (first <= 9) & (last >= 5) & (last <= 9)) / n,
        distinct / n, top / n, np.log1p(line_count), counts / np.maximum(line_count, 1), again / np.maximum(line_count, 1),
        np.bincount(line_row, weights=lines[1], minlength=rows) / np.maximum(line_count, 1), -(share * np.log(np.maximum(share, 1e-12))).sum(axis=1),
    ], axis=1)
    return out


def _runs(hashes: np.ndarray) -> np.ndarray:
    """How often each distinct value occurs."""
    s = np.sort(hashes)
    cut = np.flatnonzero(s[1:] != s[:-1]) + 1
    return np.diff(np.r_[0, cut, len(s)])


def _most(x: np.ndarray, begin: np.ndarray, has: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows)
    if has.any():
        out[has] = np.maximum.reduceat(x, begin[has])
    return out


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Non-empty lines: (hash, ends as a sentence does), and the row of each."""
    is_line = np.ones(256, dtype=bool)
    is_line[10] = False
    starts, ends, counts = words_of(data, offsets, is_line)
    last = data[ends - 1]
    return (hash_words(data, starts, ends), (last == 46) | (last == 33) | (last == 63)), np.repeat(np.arange(len(counts)), counts)


@dataclass
class Trees:
    """Full binary trees as arrays: feature and threshold by (tree, node), value by (tree, leaf)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.value[tree, node - (2**DEPTH - 1)].sum(axis=1))))


def least_leaf(x: np.ndarray, y: np.ndarray) -> int:
    """The least leaf size with the lowest logistic loss on an inner split of the training rows; the larger of equals."""
    inner = np.arange(len(y)) % 4 == 0

    def loss(least: int) -> float:
        p = np.clip(fit(x[~inner], y[~inner], least, CHOICE_ROUNDS).score(x[inner]), 1e-9, 1 - 1e-9)
        return round(float(-np.mean(y[inner] * np.log(p) + (1 - y[inner]) * np.log(1 - p))), 9)

    return min(LEASTS, key=lambda n: (loss(n), -n)) if inner.any() and not inner.all() else LEASTS[0]


def fit(x: np.ndarray, y: np.ndarray, least: int = 10, rounds: int = ROUNDS) -> Trees:
    """Logistic loss, quantile bins, second-order leaf values."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 0)), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner = 2**DEPTH - 1
    feature, threshold, value = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, 2**DEPTH))
    margin = np.full(len(y), base)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            low, width = 2**level - 1, 2**level
            at = (node - low) * BINS
            best = np.zeros(width)
            choice, where = np.zeros(width, np.int64), np.full(width, -1)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = at + binned[:, f]
                gs = np.bincount(key, weights=g, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(key, weights=h, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                ns = np.bincount(key, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                gain = gs**2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(ns < least) | (nt - ns < least)] = 0
                gain[:, len(e) :] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(width), top] > best + 1e-9
                best = np.where(better, gain[np.arange(width), top], best)
                choice, where = np.where(better, f, choice), np.where(better, top, where)
            for k in range(width):
                if where[k] >= 0:
                    feature[t, low + k], threshold[t, low + k] = choice[k], edges[choice[k]][where[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = RATE * np.bincount(leaf, weights=g, minlength=2**DEPTH) / (np.bincount(leaf, weights=h, minlength=2**DEPTH) + RIDGE)
        margin += value[t][leaf]
    return Trees(feature, threshold, value, base)


def held_out(id_col: str) -> Column:
    """Rows that training must not see."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id") -> Trees:
    """Fits on at most TRAIN_ROWS labelled rows outside the held-out part."""
    chosen = labels.select(F.col(label_id).alias(id_col), F.col(label_col).cast("int").alias("label")).filter(F.col(id_col).isNotNull() & F.col("label").isin(0, 1) & ~held_out(id_col))
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col, "label").limit(TRAIN_ROWS)
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(F.col(id_col).cast("string").alias("id"), "label", F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(2)):
                x = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(x)), batch.column(1).slice(first, len(x)), pa.array(list(x))], names=["id", "label", "x"])

    # Documents may repeat ids: the bound holds for what comes back, too.
    rows = map_batches(texts, run, "id string, label int, x array<double>").orderBy(F.xxhash64("id", "x"), "id", "label", "x").limit(TRAIN_ROWS).toArrow()
    x = np.array(rows.column("x").to_pylist()).reshape(-1, len(FEATURES))
    y = rows.column("label").to_numpy().astype(float)
    return fit(x, y, least_leaf(x, y))


def score_documents(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs, and one more at the end: score, or a name that they leave free. No shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index(text_col)
    name = "score"
    while name.lower() in map(str.lower, docs.columns):
        name = f"quality_{name}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.score(statistics(data, offsets)) for _, data, offsets in text_steps(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=[*batch.schema.names, name])

    return map_batches(docs, run, StructType([*docs.schema.fields]).add(name, DoubleType()))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score, predicted (1 from a score of 0.3)."""
    scored = score_documents(docs.select(id_col, text_col), train(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
