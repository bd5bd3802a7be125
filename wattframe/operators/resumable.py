"""Results that a stopped run leaves behind and the next one goes on from.

Rows of a key are written first, under the number of the write, and then a marker that names the key and the write. A
marker is one small file, which appears whole or not at all; rows without a marker are no results. A run asks the markers
what is done, computes the other keys in batches, and leaves a marker for each as its batch is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.session import scratch
from wattframe.sources.sinks import exists

BATCHES = 8


def finished(todo: DataFrame, keys: Sequence[str], path: str) -> DataFrame | None:
    """Keys with a marker, and the write that holds their rows; one write for a key that two runs have done."""
    spark = todo.sparkSession
    if not exists(spark, f"{path}/done"):
        return None
    fields = ", ".join(f"`{k}` {todo.schema[k].dataType.simpleString()}" for k in keys)
    return spark.read.schema(f"{fields}, write string").parquet(f"{path}/done").groupBy(*keys).agg(F.min("write").alias("write"))


def results(todo: DataFrame, keys: Sequence[str], path: str, schema) -> DataFrame:
    """The rows of finished keys; empty where nothing is finished."""
    done = finished(todo, keys, path)
    if done is None:
        return todo.sparkSession.createDataFrame([], schema)
    rows = todo.sparkSession.read.schema(f"{schema}, write string").parquet(f"{path}/rows")
    return rows.join(done, [*keys, "write"], "left_semi").drop("write")


def resume(todo: DataFrame, keys: Sequence[str], path: str, compute: Callable[[DataFrame], DataFrame], batches: int = BATCHES) -> DataFrame:
    """Computes the keys of todo that have no marker at the path, and returns the rows of all finished keys.

    The keys are written out first, since what lists them may be a long query. compute: from a DataFrame of keys to their rows,
    keys included. Keys are dealt to batches by their hash, so that a run that stops loses the batch it was at. Keys without
    rows are finished too. Null keys are refused.
    """
    spark, fields = todo.sparkSession, todo.select(*keys).schema
    where = scratch(spark, "todo")
    todo.select(*keys).distinct().write.parquet(where)
    todo = spark.read.schema(fields).parquet(where)
    if not todo.filter(" or ".join(f"`{k}` is null" for k in keys)).isEmpty():
        raise ValueError("keys of results must not be null")
    done = finished(todo, keys, path)
    left = todo if done is None else todo.join(done, list(keys), "left_anti")
    left = left.withColumn("batch", F.pmod(F.xxhash64(*keys), F.lit(batches)))
    schema = None
    for r in left.groupBy("batch").count().orderBy("batch").collect():  # a row for each batch
        mine = left.filter(F.col("batch") == r.batch).drop("batch")
        rows = compute(mine)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        write = uuid.uuid4().hex
        rows.write.parquet(f"{path}/rows/write={write}")
        mine.withColumn("write", F.lit(write)).coalesce(1).write.mode("append").parquet(f"{path}/done")
    if schema is None:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in compute(todo).schema.fields)
    return results(todo, keys, path, schema)
