"""Helpers that the text operators share: table access, shared storage and vectorised word scanning."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wattframe.session import scratch, ship

#: Bytes of text that one vectorised step handles; bounds a worker's memory whatever the batch holds.
STEP_BYTES = 1 << 20

#: A-Z to a-z over bytes; UTF-8 continuation bytes are untouched.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of settled tables, a list for each temporary() around.
_held: list[list[str]] = []


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    if _held:
        _held[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Deletes a settled table once everything made from it is settled too."""
    _delete(df.sparkSession, df.settled_path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables settled inside go at the end, also after a failure, but for those given to the yielded function."""
    mine: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        mine.remove(df.settled_path)
        return df

    _held.append(mine)
    try:
        yield keep
    finally:
        _held.remove(mine)
        for path in mine:
            _delete(spark, path)


#: Bytes of one Arrow batch between Spark and a Python worker: batches hold whole texts, so rows alone don't bound them.
BATCH_BYTES = 4 << 20


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches bounded in bytes.

    The bound is a setting of the session, read when the plan runs, so it can't be put back here; a lower one of the caller stays.
    """
    spark = df.sparkSession
    ship(spark)
    bound = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")
    if not bound.isdigit() or not 0 < int(bound) <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, in place on a fresh array."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_factors = np.ones(0, dtype=np.uint64)


def factors(n: int) -> np.ndarray:
    """A factor for each of at least n places, odd and independent: powers of one base would let long patterned words collide."""
    global _factors
    if len(_factors) < n:
        _factors = mix(np.arange(1, (1 << n.bit_length()) + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    return _factors


def text_steps(column: pa.Array, step: int = STEP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first row, bytes, offsets) for runs of rows of about `step` bytes; null counts as empty.

    A text longer than the step is a step of its own: it is never cut.
    """
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + step, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends (byte positions) and the number of words in each row.

    is_word: a table of 256 booleans over lower-cased bytes. Rows never share a word.
    """
    inside = is_word[data]
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    first = np.zeros(len(data), dtype=bool)
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:] & ~first[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    at = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(at)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for each word."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    total = int(sizes.sum())
    begin = np.zeros(len(sizes), dtype=np.int64)
    np.cumsum(sizes[:-1], out=begin[1:])
    place = np.arange(total, dtype=np.int64) - np.repeat(begin, sizes)
    codes = BYTE_CODES[data[np.repeat(starts, sizes) + place]]
    codes *= factors(int(sizes.max()))[place]
    return mix(np.add.reduceat(codes, begin) ^ sizes.astype(np.uint64))


def as_int64(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
