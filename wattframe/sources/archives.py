"""Zip archives as a data source that Spark plans by member.

The driver reads an archive's directory alone, at its end, and plans a partition for each run of neighbouring members of up to
SPLIT_BYTES compressed bytes. A task opens the archive, goes to its members and reads their bytes and no others, as a
stream: neither an archive nor a member is ever held whole. Files are opened through pyarrow's file systems, so that
local paths and the stores it knows are read alike.

A member is a text file: some lines of metadata 'FIELD:;value', a header, rows with `;` between fields and at will at their
end. A member whose header isn't the declared one, a row with too few fields and a damaged, encrypted or unknown kind of
member fail the job.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wattframe.session import ship
from wattframe.sources.text import LayoutError, header_names, preamble

#: Compressed bytes that one task reads, where members allow it: a larger member is a task of its own.
SPLIT_BYTES = 16 << 20
#: Bytes that a member's stream reads and unpacks at once, and rows of one batch.
CHUNK, BATCH_ROWS = 1 << 18, 4096


def opened(path: str) -> tuple[stores.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return stores.FileSystem.from_uri(path)


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    packed: int
    size: int
    crc: int
    kind: int


def directory(path: str) -> list[Member]:
    """The members of an archive in the order of their bytes; only its end is read."""
    store, inside = opened(path)
    with store.open_input_file(inside) as f:
        try:
            with zipfile.ZipFile(f) as archive:
                found = archive.infolist()
        except (zipfile.BadZipFile, pa.ArrowInvalid) as e:
            raise LayoutError(f"{path} is not an archive") from e
    if any(m.flag_bits & 1 for m in found):
        raise LayoutError(f"{path} is encrypted")
    members = [Member(m.filename, m.header_offset, m.compress_size, m.file_size, m.CRC, m.compress_type) for m in found if not m.is_dir()]
    return sorted(members, key=lambda m: m.offset)


class MemberStream(io.RawIOBase):
    """The unpacked bytes of one member, a chunk at a time; size and checksum are held against the directory's at the end."""

    def __init__(self, file, member: Member) -> None:
        if member.kind not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise LayoutError(f"{member.name}: unknown compression {member.kind}")
        file.seek(member.offset)
        head = file.read(30)
        if head[:4] != b"PK\x03\x04":
            raise LayoutError(f"damaged archive at {member.name}")
        file.seek(member.offset + 30 + sum(struct.unpack("<HH", head[26:30])))
        self.file, self.member, self.left, self.crc, self.size = file, member, member.packed, 0, 0
        self.unpack = zlib.decompressobj(-15) if member.kind == zipfile.ZIP_DEFLATED else None
        self.rest = b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        want = min(len(buffer), CHUNK)
        out = b""
        while not out:
            if not self.rest and self.left:
                self.rest = self.file.read(min(CHUNK, self.left))
                if not self.rest:
                    raise LayoutError(f"damaged archive at {self.member.name}")
                self.left -= len(self.rest)
            if self.unpack is None:
                out, self.rest = self.rest[:want], self.rest[want:]
            else:
                try:
                    out = self.unpack.decompress(self.rest, want)
                except zlib.error as e:
                    raise LayoutError(f"damaged archive at {self.member.name}") from e
                self.rest = self.unpack.unconsumed_tail
            if not out and not self.rest and not self.left:
                if self.size != self.member.size or self.crc != self.member.crc:
                    raise LayoutError(f"damaged archive at {self.member.name}")
                return 0
        self.size += len(out)
        self.crc = zlib.crc32(out, self.crc)
        buffer[: len(out)] = out
        return len(out)


class Run(InputPartition):
    """Neighbouring members of one archive."""

    def __init__(self, path: str, members: list[Member]) -> None:
        self.path, self.members = path, members


def runs(path: str, members: list[Member], most: int) -> list[Run]:
    out, held, size = [], [], 0
    for m in members:
        if held and size + m.packed > most:
            out.append(Run(path, held))
            held, size = [], 0
        held.append(m)
        size += m.packed
    return [*out, Run(path, held)] if held else out


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.columns = options["path"], json.loads(options["columns"])
        self.lines, self.encoding, self.most = int(options.get("lines", 8)), options.get("encoding", "latin-1"), int(options.get("splitbytes", SPLIT_BYTES))

    def archives(self) -> list[str]:
        store, inside = opened(self.path)
        if store.get_file_info(inside).type == stores.FileType.File:
            return [self.path]
        found = store.get_file_info(stores.FileSelector(inside))
        return sorted(f"{self.path.rstrip('/')}/{f.base_name}" for f in found if f.type == stores.FileType.File and f.extension == "zip")

    def partitions(self) -> Sequence[Run]:
        return [run for path in self.archives() for run in runs(path, directory(path), self.most)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        store, inside = opened(partition.path)
        with store.open_input_file(inside) as f:
            for member in partition.members:
                yield from self.rows(member, io.TextIOWrapper(io.BufferedReader(MemberStream(f, member), CHUNK), self.encoding))

    def rows(self, member: Member, text: io.TextIOWrapper) -> Iterator[pa.RecordBatch]:
        head = [text.readline().rstrip("\n") for _ in range(self.lines + 1)]
        meta, header = preamble(head, self.lines), [h for h in head[self.lines].split(";") if h]
        if header_names(header) != self.columns:
            raise LayoutError(f"unexpected columns in {member.name}")
        width, held = len(self.columns), []
        for line in text:
            line = line.rstrip("\n")
            if not line:
                continue
            fields = line.split(";")
            if len(fields) < width:
                raise LayoutError(f"short row in {member.name}")
            held.append(fields[:width])
            if len(held) == BATCH_ROWS:
                yield self.batch(member, meta, held)
                held = []
        if held:
            yield self.batch(member, meta, held)

    def batch(self, member: Member, meta: dict[str, str], rows: list[list[str]]) -> pa.RecordBatch:
        n = len(rows)
        fixed = [pa.array([member.name] * n), pa.array([list(meta.items())] * n, pa.map_(pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays([*fixed, *(pa.array(c, pa.string()) for c in zip(*rows, strict=True))], names=["member", "preamble", *self.columns])


class StationArchives(DataSource):
    """spark.read.format("station_archives"): path (an archive or a folder of them), columns (a JSON list), lines, encoding, splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "station_archives"

    def schema(self) -> str:
        return "member string, preamble map<string,string>, " + ", ".join(f"`{c}` string" for c in json.loads(self.options["columns"]))

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, path: str, columns: Sequence[str], lines: int = 8, encoding: str = "latin-1", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """member, the preamble as a map, and the declared columns as text, of all archives at the path."""
    ship(spark)
    spark.dataSource.register(StationArchives)
    read = spark.read.format("station_archives").option("columns", json.dumps(list(columns))).option("lines", str(lines)).option("encoding", encoding)
    return read.option("splitBytes", str(split_bytes)).load(path)


def write_archives(df: DataFrame, path: str, archive: str, member: str, order: str, text: str, encoding: str = "latin-1") -> DataFrame:
    """Writes lines into archives as a stream, one archive in one task, and returns their names and members; evaluating it writes.

    Columns of df name the archive, the member, the order of its lines, and a line. An archive gets its name only when it
    is whole, so that a task that runs again replaces what it left.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(archive).cast("string").alias("archive"), F.col(member).cast("string").alias("member"), F.col(order).alias("order"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(path)
        store.create_dir(folder, recursive=True)
        name = inner = packed = entry = sink = part = None
        count = 0

        def finished() -> Iterator[pa.RecordBatch]:
            if name is None:
                return
            entry.close()
            packed.close()
            sink.close()
            store.move(part, f"{folder}/{name}.zip")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], names=["archive", "members"])

        for batch in batches:
            for a, m, _, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != name:
                    yield from finished()
                    name, inner, count = a, None, 0
                    part = f"{folder}/.{a}.{uuid.uuid4().hex}.part"
                    sink = store.open_output_stream(part)
                    packed = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                    entry = None
                if m != inner:
                    if entry is not None:
                        entry.close()
                    inner, count = m, count + 1
                    entry = packed.open(m, "w", force_zip64=True)
                entry.write(f"{line}\n".encode(encoding))
        yield from finished()

    return rows.repartition("archive").sortWithinPartitions("archive", "member", "order").mapInArrow(run, "archive string, members long")
