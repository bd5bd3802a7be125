"""Archives read by member: plans, streams, and what is refused."""

import io
import os
import random
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from wattframe.sources import archives
from wattframe.sources.text import LayoutError

HEAD = "STATE:;São Paulo\nCODE:;A1\nDAY;VALUE;\n"


def packed(path, members, kind=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", kind) as z:
        z.mkdir("folder")
        for name, text in members:
            z.writestr(name, text.encode("latin-1"))
    return str(path)


def body(rows, seed=0):
    draw = random.Random(seed)
    return HEAD + "".join(f"{k};{draw.random()};\n" for k in range(rows))


@pytest.mark.parametrize("kind", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_runs_of_members_are_tasks(spark, tmp_path, kind):
    members = [(f"m{k:02d}.csv", body(300 if k != 7 else 9000, k)) for k in range(20)]
    path = packed(tmp_path / "a.zip", members, kind)
    packed(tmp_path / "b.zip", [("z.csv", body(3)), ("empty.csv", HEAD + "\n\n")])
    (tmp_path / "note.txt").write_text("not an archive")
    most = 20_000
    planned = archives.runs(path, archives.directory(path), most)
    assert [m.name for r in planned for m in r.members] == [n for n, _ in members]
    assert all(sum(m.packed for m in r.members) <= most or len(r.members) == 1 for r in planned) and len(planned) > 3
    read = archives.read_archives(spark, str(tmp_path), ["day", "value"], lines=2, split_bytes=most)
    rows = read.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows if r.member != "z.csv"}) == len(planned)
    assert {r.preamble["state"] for r in rows} == {"São Paulo"}
    got = {}
    for r in rows:
        got.setdefault(r.member, []).append(f"{r.day};{r.value};")
    want = {n: t[len(HEAD) :].split("\n")[:-1] for n, t in members} | {"z.csv": body(3)[len(HEAD) :].split("\n")[:-1]}
    assert got == want
    assert archives.read_archives(spark, path, ["day", "value"], lines=2).count() == 19 * 300 + 9000


def test_a_large_member_is_a_stream(tmp_path):
    """14 MB of rows pass through less than 4 MB."""
    path = packed(tmp_path / "large.zip", [("a.csv", HEAD + "1;22222222222;\n" * 950_000)])
    member = archives.directory(path)[0]
    reader = archives.ArchiveReader({"path": path, "columns": '["day", "value"]', "lines": "2"})
    tracemalloc.start()
    rows = sum(b.num_rows for b in reader.read(archives.Run(path, [member])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 950_000 and member.size > 14e6 and peak < 4e6


def test_planning_reads_the_directory_alone(tmp_path, monkeypatch):
    path = packed(tmp_path / "a.zip", [(f"{k}.csv", body(4000, k)) for k in range(10)], zipfile.ZIP_STORED)
    seen = []

    class Counted(io.FileIO):
        def read(self, n=-1):
            out = super().read(n)
            seen.append(len(out))
            return out

    class Store:
        def open_input_file(self, p):
            return Counted(p)

    monkeypatch.setattr(archives, "opened", lambda p: (Store(), p))
    assert len(archives.directory(path)) == 10
    assert sum(seen) < 5000 < 0.01 * os.path.getsize(path)


def test_bad_archives_are_refused(spark, tmp_path):
    reader = lambda path: archives.ArchiveReader({"path": str(path), "columns": '["day", "value"]', "lines": "2"})
    path = packed(tmp_path / "a.zip", [("a.csv", body(500))], zipfile.ZIP_STORED)
    raw = bytearray(open(path, "rb").read())
    raw[2000] ^= 1
    (tmp_path / "b.zip").write_bytes(raw)
    for name, error in (("b.zip", "damaged"),):
        r = reader(tmp_path / name)
        with pytest.raises(LayoutError, match=error):
            list(r.read(r.partitions()[0]))
    for text, error in ((HEAD.replace("VALUE", "OTHER") + "1;2\n", "columns"), (HEAD + "1\n", "short")):
        r = reader(packed(tmp_path / "c.zip", [("c.csv", text)]))
        with pytest.raises(LayoutError, match=error):
            list(r.read(r.partitions()[0]))
    (tmp_path / "d.zip").write_bytes(b"no archive at all")
    with pytest.raises(LayoutError):
        reader(tmp_path / "d.zip").partitions()
    with pytest.raises(Exception, match="damaged"):
        archives.read_archives(spark, str(tmp_path / "b.zip"), ["day", "value"], lines=2).collect()


def test_writing_streams_whole_archives(spark, tmp_path):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("a"), F.concat((F.col("id") % 7).cast("string"), F.lit(".csv")).alias("m"), "id", F.concat(F.lit("é"), F.col("id").cast("string")).alias("t"))
    done = {r.archive: r.members for r in archives.write_archives(df, str(tmp_path / "out"), "a", "m", "id", "t").collect()}
    assert done == {"0": 7, "1": 7, "2": 7} and sorted(os.listdir(tmp_path / "out")) == ["0.zip", "1.zip", "2.zip"]
    with zipfile.ZipFile(tmp_path / "out/1.zip") as z:
        assert z.testzip() is None and z.read("3.csv").decode("latin-1").split() == [f"é{i}" for i in range(5000) if i % 3 == 1 and i % 7 == 3]
