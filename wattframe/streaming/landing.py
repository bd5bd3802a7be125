"""Files of a landing folder, and the state of the last load that succeeded.

The state is a versioned table of file, size, time and digest. A load looks at the listing alone for files whose size and
time are the state's, reads the others for their digest, and leaves out those whose contents are the same, touched or not; a
file of a closed period is left out by its digest, too. What is left is processed, and only then becomes the state, in one
version: a load that fails leaves the state as it was, and of two loads at once the second can't put its own in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.operators.relational import upserted
from wattframe.session import scratch
from wattframe.sources.versions import Table

MARKS = "file string, size bigint, time bigint, digest string"


class Landing:
    def __init__(self, spark: SparkSession, folder: str, state: str, name: str = r"([^/]+)$") -> None:
        """name: a pattern whose first group is a file's name in its path."""
        self.spark, self.folder, self.name = spark, folder, name
        self.table = Table(spark, state)

    def state(self, version: int | None = None) -> DataFrame:
        n = self.table.version() if version is None else version
        return self.table.read(n) if n else self.spark.createDataFrame([], MARKS)

    def listing(self) -> DataFrame:
        """file, path, size, time (milliseconds); contents are not read."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.folder)
        return found.select(F.regexp_extract("path", self.name, 1).alias("file"), "path", F.col("length").alias("size"), F.unix_millis("modificationTime").alias("time"))

    def marks(self, base: DataFrame) -> DataFrame:
        """file, path, size, time, digest and what it is beside the state: new, changed, touched (other time, same contents)."""
        old = base.select("file", F.col("size").alias("size0"), F.col("time").alias("time0"), F.col("digest").alias("digest0"))
        moved = self.listing().join(old, "file", "left").filter(~(F.col("size").eqNullSafe(F.col("size0")) & F.col("time").eqNullSafe(F.col("time0"))))
        contents = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.folder).select("path", F.md5("content").alias("digest"))
        # Spark reads a file's bytes where its digest is asked for: here, of files that moved.
        met = moved.join(contents, "path")
        kind = F.when(F.col("digest0").isNull(), "new").when(F.col("digest0") == F.col("digest"), "touched").otherwise("changed")
        return met.select("file", "path", "size", "time", "digest", kind.alias("kind"))

    def load(self, process: Callable[[DataFrame], None], closed: Column | None = None) -> DataFrame:
        """Processes new and changed files (file, path, kind) and returns file, kind of all that moved.

        closed: files of periods that must not change; a changed one of these is refused before anything is processed.
        """
        base = self.table.version()
        path = scratch(self.spark, "marks")
        self.marks(self.state(base)).write.parquet(path)
        moved = self.spark.read.schema(f"file string, path string, {MARKS.removeprefix('file string, ')}, kind string").parquet(path)
        if closed is not None:
            bad = [r.file for r in moved.filter(closed & (F.col("kind") == "changed")).select("file").limit(20).collect()]
            if bad:
                raise ValueError(f"files of closed periods changed: {bad}")
        todo = moved.filter("kind <> 'touched'")
        if not todo.isEmpty():
            process(todo.select("file", "path", "kind"))
        if not moved.isEmpty():
            self.table.replace(upserted(self.state(base), moved.select("file", "size", "time", "digest"), ["file"]), base)
        return moved.select("file", "kind")
