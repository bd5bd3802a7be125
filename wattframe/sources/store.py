"""An archive of file versions: contents by their digest, and an index by file name.

Tasks write contents, so that nothing passes through the driver. A content is written once, whatever the number of files
and versions that have it; its name is its SHA-256, and it gets the name only when it is whole. The index is a versioned
table: a sync that stops leaves the index as it was, and contents that it already wrote are found again by the next.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.session import ship
from wattframe.sources.archives import opened
from wattframe.sources.versions import Table

INDEX = "file string, version int, digest string"


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        ship(spark)
        self.spark, self.path = spark, path.rstrip("/")
        self.index_table = Table(spark, f"{self.path}/index")

    def index(self) -> DataFrame:
        """file, version (from 1), digest of every version of every file."""
        return self.index_table.read() if self.index_table.version() else self.spark.createDataFrame([], INDEX)

    def latest(self) -> DataFrame:
        return self.index().groupBy("file").agg(F.max_by("digest", "version").alias("digest"), F.max("version").alias("version"))

    def sync(self, files: DataFrame) -> DataFrame:
        """Takes in files (file, content) and returns file, action: new, same (nothing is written) or changed (a version more).

        A file that comes twice must come with equal contents. Files that are missing keep their versions.
        """
        put = self._put(files.select("file", "content"))
        seen = put.groupBy("file").agg(F.min("digest").alias("digest"), F.max("digest").alias("other"))
        where = f"{self.path}/seen/{uuid.uuid4().hex}"
        seen.write.parquet(where)
        seen = self.spark.read.schema("file string, digest string, other string").parquet(where)
        twice = seen.filter("digest <> other").select("file").limit(3).collect()
        if twice:
            raise ValueError(f"files with two contents: {[r.file for r in twice]}")
        before = self.latest().select("file", F.col("digest").alias("before"), "version")
        met = seen.drop("other").join(before, "file", "left").withColumn("action", F.when(F.col("before").isNull(), "new").when(F.col("before") == F.col("digest"), "same").otherwise("changed"))
        more = met.filter("action <> 'same'").select("file", (F.coalesce("version", F.lit(0)) + 1).cast("int").alias("version"), "digest")
        actions = met.select("file", "action")
        done = f"{self.path}/seen/{uuid.uuid4().hex}"
        actions.write.parquet(done)
        if not more.isEmpty():
            self.index_table.append(more)
        return self.spark.read.schema("file string, action string").parquet(done)

    def _put(self, files: DataFrame) -> DataFrame:
        """Writes the contents that aren't there, by tasks: file, digest."""
        path = f"{self.path}/objects"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, folder = opened(path)
            store.create_dir(folder, recursive=True)
            for batch in batches:
                digests = []
                for value in batch.column(1):
                    raw = value.as_buffer() if value.is_valid else pa.py_buffer(b"")
                    digest = hashlib.sha256(raw).hexdigest()
                    digests.append(digest)
                    if store.get_file_info(f"{folder}/{digest}").type == stores.FileType.NotFound:
                        side = f"{folder}/.{uuid.uuid4().hex}"
                        with store.open_output_stream(side) as out:
                            out.write(raw)
                        store.move(side, f"{folder}/{digest}")
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], names=["file", "digest"])

        return files.mapInArrow(run, "file string, digest string")

    def read(self, index: DataFrame | None = None) -> DataFrame:
        """file, version, content: every version, or those of the given rows of the index."""
        wanted = (self.index() if index is None else index).select("file", "version", "digest")
        path = f"{self.path}/objects"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, folder = opened(path)
            for batch in batches:
                for row in range(batch.num_rows):
                    with store.open_input_stream(f"{folder}/{batch.column(2)[row].as_py()}") as f:
                        raw = f.read()
                    yield pa.RecordBatch.from_arrays([*(c.slice(row, 1) for c in batch.columns[:2]), pa.array([raw], pa.binary())], names=["file", "version", "content"])

        return wanted.mapInArrow(run, "file string, version int, content binary")
