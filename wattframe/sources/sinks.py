"""Writing: partition replacement and snapshots on plain Parquet folders. Tables that are replaced as a whole are in versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class PartitionError(ValueError):
    """Rows or tables that don't fit the declared partitions."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def replace_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders, from a listing: no data is read."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def check_partitioned(spark: SparkSession, path: str, column: str) -> None:
    """Refuses a table that is partitioned otherwise."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        folders = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith("_")]
        if any(not n.startswith(f"{column}=") for n in folders):
            raise PartitionError(f"{path} is not partitioned by {column}")


def replace_partitions(df: DataFrame, path: str, column: str, listed: Sequence[str]) -> None:
    """Replaces the listed partitions: those that got no rows are emptied, rows of others are refused before any write."""
    spark = df.sparkSession
    check_partitioned(spark, path, column)
    got = {str(r[0]) for r in df.select(F.col(column).cast("string")).distinct().limit(len(set(listed)) + 1).collect()}
    if got - set(listed):
        raise PartitionError(f"rows outside the listed partitions: {sorted(got - set(listed))[:3]}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    drop_partitions(spark, path, column, [v for v in listed if v not in got])


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    fs, _ = _fs(spark, path)
    for v in values:
        if "/" in v or "=" in v or not v:
            raise PartitionError(f"not a partition value: {v!r}")
        _, p = _fs(spark, f"{path}/{column}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def add_columns(df: DataFrame, more: DataFrame) -> DataFrame:
    """Rows of both; a column that only one has is null for the other's."""
    return df.unionByName(more, allowMissingColumns=True)


def csv_text(df: DataFrame, order: Sequence[str], most_rows: int = 100_000) -> str:
    """A small result as CSV with a fixed row order, number format and line end; one of more rows than most_rows is refused."""
    rows = df.orderBy(*order).limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows are no snapshot")
    plain = lambda v: "" if v is None else repr(float(v)) if isinstance(v, float) else str(v)
    return "\n".join([",".join(df.columns), *[",".join(plain(v) for v in r) for r in rows]]) + "\n"


def manifest(spark: SparkSession, tables: dict[str, DataFrame], most_rows: int = 1_000_000) -> DataFrame:
    """name, rows, fingerprint of each table; the fingerprint doesn't depend on row order and needs no sort."""
    out = None
    for name, df in sorted(tables.items()):
        h = F.conv(F.substring(F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256), 1, 15), 16, 10).cast("decimal(20,0)")
        row = df.agg(F.count("*").alias("rows"), F.sum(h).cast("string").alias("fingerprint")).select(F.lit(name).alias("name"), "rows", "fingerprint", (F.col("rows") <= most_rows).alias("within_limit"))
        out = row if out is None else out.unionByName(row)
    return out
