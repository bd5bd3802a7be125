"""Tables as immutable versions behind one pointer, and files that only one of several writers can create.

A write makes new folders beside the old ones and then publishes the number of the next version, with the list of
its folders. A reader takes the highest number there is. A write that stops anywhere before leaves the old table, and
nothing lies between the old and the new one. Numbers are created exclusively: of two writers that start from the same
version the second is refused, and its folders are never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.operators.relational import upserted
from wattframe.sources.sinks import PartitionError, _fs

#: The partition of a table without partitions.
WHOLE = ""


class Conflict(RuntimeError):
    """Another writer published the version that this one meant to."""


def publish(spark: SparkSession, path: str, content: str) -> bool:
    """Creates a file with all of its content, unless it is there: True for one of several writers at most.

    The content is written under a name of its own first. On a local disk a hard link gives it the name, elsewhere a rename;
    both fail where the name is taken. A store whose rename copies and overwrites gives no such promise.
    """
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    _, side = _fs(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(side, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = lambda p: jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()
            return bool(jvm.java.nio.file.Files.createLink(local(target), local(side)))
        return not fs.exists(target) and fs.rename(side, target)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(side, False)


def content(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def numbers(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    """The numbers of a folder's files `prefix<number>`, ascending."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


class Table:
    """A table at a path. Folders are Parquet files of one partition each; the manifest names them, a line a partition."""

    def __init__(self, spark: SparkSession, path: str, column: str | None = None) -> None:
        """column: what the table is partitioned by, as text."""
        self.spark, self.path, self.column = spark, path.rstrip("/"), column

    def version(self) -> int:
        """The number of the current version, 0 where there is none."""
        return max(numbers(self.spark, f"{self.path}/_versions"), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """Folders by partition, the schema and the partition column of a version."""
        n = self.version() if version is None else version
        found = json.loads(content(self.spark, f"{self.path}/_versions/{n:012d}")) if n else {"column": self.column, "schema": None, "parts": {}}
        if found["column"] != self.column:
            raise PartitionError(f"{self.path} is partitioned by {found['column']}, not by {self.column}")
        return found

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version. Folders are immutable: what is being read stays until vacuum() takes it."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise FileNotFoundError(self.path)
        folders = [f"{self.path}/{f}" for f in found["parts"].values()]
        return self.spark.read.schema(found["schema"]).parquet(*folders) if folders else self.spark.createDataFrame([], found["schema"])

    def _write(self, df: DataFrame) -> dict[str, str]:
        """New folders by partition; nobody reads them yet."""
        name = f"data/{uuid.uuid4().hex}"
        if self.column is None:
            df.write.parquet(f"{self.path}/{name}")
            return {WHOLE: name}
        # The partition's column stays in the files, so that a folder can be read by itself.
        df.withColumn("__part", F.col(self.column).cast("string")).write.partitionBy("__part").parquet(f"{self.path}/{name}")
        fs, p = _fs(self.spark, f"{self.path}/{name}")
        folders = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return {self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(f.split("=", 1)[1]): f"{name}/{f}" for f in folders if f.startswith("__part=")}

    def commit(self, base: int, old: dict[str, str], new: dict[str, str], schema: str) -> int:
        """Publishes the version after `base`: old folders and new ones. Where that is refused, the new ones go."""
        try:
            if both := sorted(old.keys() & new.keys()):
                raise PartitionError(f"partitions are there already: {both[:3]}")
            if not publish(self.spark, f"{self.path}/_versions/{base + 1:012d}", json.dumps({"column": self.column, "schema": schema, "parts": old | new}, sort_keys=True)):
                raise Conflict(f"{self.path}: version {base + 1} is another writer's")
        except (PartitionError, Conflict):
            for folder in {f.partition("/__part=")[0] for f in new.values()}:
                self._delete(folder)
            raise
        return base + 1

    def replace(self, df: DataFrame, base: int | None = None) -> int:
        """All rows anew. base: the version that the caller has seen, if that was before."""
        base = self.version() if base is None else base
        self.manifest(base)
        return self.commit(base, {}, self._write(df), _ddl(df))

    def append(self, df: DataFrame) -> int:
        """More rows in an unpartitioned table, or more partitions."""
        base = self.version()
        found, new = self.manifest(base), self._write(df)
        if self.column is None:
            new = {f"{WHOLE}{base + 1}": f for f in new.values()}
        return self.commit(base, found["parts"], new, found["schema"] or _ddl(df))

    def replace_partitions(self, df: DataFrame, listed: Sequence[str]) -> int:
        """The listed partitions anew, all at once; those without rows are emptied, rows of others are refused before any write."""
        if self.column is None:
            raise PartitionError(f"{self.path} has no partitions")
        base = self.version()
        found = self.manifest(base)
        other = df.filter(~F.coalesce(F.col(self.column).cast("string").isin(*listed), F.lit(False))).select(F.col(self.column).cast("string")).limit(1).collect()
        if other:
            raise PartitionError(f"rows outside the listed partitions: {other[0][0]}")
        left = {k: f for k, f in found["parts"].items() if k not in set(listed)}
        return self.commit(base, left, self._write(df), found["schema"] or _ddl(df))

    def upsert(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Rows of the source in place of those of their keys, and new ones; the table of one writer or of the other, never of both."""
        bad = source.groupBy(*keys).agg(F.count("*").alias("n")).filter(" or ".join([f"`{k}` is null" for k in keys] + ["n > 1"]))
        if not bad.isEmpty():
            raise PartitionError("upsert keys must be unique and not null")
        base = self.version()
        return self.replace(upserted(self.read(base), source, keys) if base else source, base)

    def delete(self, doomed: Column) -> int:
        """All rows but those where the condition holds (null: they stay)."""
        base = self.version()
        return self.replace(self.read(base).filter(~F.coalesce(doomed, F.lit(False))), base)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes folders that only versions before the last `keep` have, and these versions' manifests, oldest first."""
        every = numbers(self.spark, f"{self.path}/_versions")
        old, kept = every[:-keep], every[-keep:]
        used = {f for n in kept for f in self.manifest(n)["parts"].values()}
        for n in old:
            for folder in self.manifest(n)["parts"].values():
                if folder not in used:
                    self._delete(folder)
            self._delete(f"_versions/{n:012d}")

    def _delete(self, name: str) -> None:
        fs, p = _fs(self.spark, f"{self.path}/{name}")
        fs.delete(p, True)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
