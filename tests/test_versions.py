"""Versions behind a pointer, the lock of one run, loads at once, and the archive of file versions: each stopped midway or crossed by another writer."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from wattframe.sources import loads, locks, sinks, store, versions


def rows(df):
    return sorted(map(tuple, df.collect()))


# Versions


def test_publish_gives_a_name_once(spark, tmp_path):
    path = str(tmp_path / "p" / "1")
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(versions.publish(spark, path, f"writer {k}"))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]
    assert versions.content(spark, path).startswith("writer ") and os.listdir(tmp_path / "p") == ["1"]


@pytest.mark.parametrize("stop_at", ["_write", "commit", None])
def test_a_write_that_stops_leaves_the_old_table(spark, tmp_path, monkeypatch, stop_at):
    t = versions.Table(spark, str(tmp_path / "t"), "m")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, m string")
    t.replace(first)

    class Stop(Exception):
        pass

    if stop_at:
        def stop(self, *a):
            if stop_at == "commit":
                raise Stop
            real(self, *a)
            raise Stop  # after the folders are there

        real = getattr(versions.Table, stop_at)
        monkeypatch.setattr(versions.Table, stop_at, stop)
        with pytest.raises(Stop):
            t.replace_partitions(first.filter("m = 'a'").withColumn("x", F.lit(9)), ["a", "b"])
        assert rows(t.read().fillna("-")) == [(1, "a"), (2, "b"), (3, "-")] and t.version() == 1
        monkeypatch.undo()
    t.replace_partitions(first.filter("m = 'a'").withColumn("x", F.lit(9)), ["a", "b"])
    assert rows(t.read().fillna("-")) == [(3, "-"), (9, "a")] and rows(t.read(1).fillna("-")) == [(1, "a"), (2, "b"), (3, "-")]


def test_the_second_of_two_writers_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = versions.Table(spark, path), versions.Table(spark, path)
    one.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    real = versions.Table._write

    def crossed(self, df):
        monkeypatch.setattr(versions.Table, "_write", real)
        two.upsert(spark.createDataFrame([(2, "two")], "k int, v string"), ["k"])
        return real(self, df)

    monkeypatch.setattr(versions.Table, "_write", crossed)
    with pytest.raises(versions.Conflict):
        one.upsert(spark.createDataFrame([(1, "one")], "k int, v string"), ["k"])
    assert rows(one.read()) == [(1, "a"), (2, "two")]
    one.upsert(spark.createDataFrame([(1, "one"), (3, "c")], "k int, v string"), ["k"])
    assert rows(one.read()) == [(1, "one"), (2, "two"), (3, "c")]


def test_tables_refuse_what_does_not_fit(spark, tmp_path):
    t = versions.Table(spark, str(tmp_path / "t"), "m")
    df = spark.createDataFrame([(1, "a b/c=d"), (2, "b")], "x int, m string")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.replace(df)
    assert rows(t.read().filter("m = 'a b/c=d'")) == [(1, "a b/c=d")]
    with pytest.raises(sinks.PartitionError):
        t.replace_partitions(df, ["b"])
    with pytest.raises(sinks.PartitionError):
        t.append(df.filter("m = 'b'"))
    with pytest.raises(sinks.PartitionError):
        versions.Table(spark, t.path).read()
    for bad in ([(None, "x")], [(1, "x"), (1, "y")]):
        with pytest.raises(sinks.PartitionError):
            t.upsert(spark.createDataFrame(bad, "x int, m string"), ["x"])
    t.append(spark.createDataFrame([(3, "c")], "x int, m string"))
    t.delete(F.col("x") == 1)
    assert rows(t.read()) == [(2, "b"), (3, "c")] and t.version() == 3
    t.vacuum(keep=1)
    assert rows(t.read()) == [(2, "b"), (3, "c")] and versions.numbers(spark, f"{t.path}/_versions") == [3]
    left = sum(f.endswith(".parquet") for _, _, names in os.walk(tmp_path / "t/data") for f in names)
    assert left == sum(f.endswith(".parquet") for p in t.manifest()["parts"].values() for f in os.listdir(tmp_path / "t" / p))
    t.replace(df.limit(0))
    assert rows(t.read()) == []


# The lock


def test_lock_is_exclusive_until_its_lease_ends(spark, tmp_path):
    now = [1000.0]
    lock = lambda owner: locks.RunLock(spark, str(tmp_path / "lock"), owner, 60, lambda: now[0])
    a, b, c = lock("a"), lock("b"), lock("c")
    a.acquire()
    with pytest.raises(locks.Locked, match="a holds"):
        b.acquire()
    now[0] += 50
    a.renew()
    now[0] += 50  # past the first lease, not past its renewal
    with pytest.raises(locks.Locked):
        b.acquire()
    a.check()
    now[0] += 61
    b.acquire()  # stale: taken over
    for step in (a.check, a.renew):
        with pytest.raises(locks.Locked, match="no longer"):
            step()
    a.release()  # its own number, not b's
    with pytest.raises(locks.Locked, match="b holds"):
        c.acquire()
    b.release()
    c.acquire()
    assert c.holder()[:2] == (3, "c")


def test_one_of_many_takes_a_stale_lease(spark, tmp_path):
    path = str(tmp_path / "lock")
    locks.RunLock(spark, path, "old", -1).acquire()
    won = []

    def take(k):
        try:
            locks.RunLock(spark, path, f"run {k}").acquire()
            won.append(k)
        except locks.Locked:
            pass

    threads = [threading.Thread(target=take, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1


def test_runs_on_frozen_inputs(spark, tmp_path):
    path = str(tmp_path / "run")
    prints = lambda h: lambda: spark.createDataFrame([("use", h), ("price", "p")], "input string, h string")
    done = []

    def work(lock):
        with pytest.raises(locks.Locked):
            locks.frozen_run(spark, path, "second", prints("x"), lambda _: done.append("second"))
        done.append("first")

    locks.frozen_run(spark, path, "first", prints("x"), work)
    assert done == ["first"]
    with pytest.raises(locks.Moved, match="use"):
        locks.frozen_run(spark, path, "moved", prints("y"), lambda _: done.append("moved"))
    with pytest.raises(ZeroDivisionError):
        locks.frozen_run(spark, path, "fails", prints("x"), lambda _: 1 / 0)
    seen = iter("xyy")  # the input moves while the run works
    with pytest.raises(locks.Moved):
        locks.frozen_run(spark, path, "meanwhile", lambda: prints(next(seen))(), lambda _: done.append("meanwhile"))
    locks.frozen_run(spark, path, "third", prints("x"), lambda lock: done.append("third"))
    assert done == ["first", "meanwhile", "third"]


# Loads at once


def test_loads_are_reported_one_by_one(spark, tmp_path):
    df = spark.range(100)

    def write(name):
        return lambda: df.write.parquet(str(tmp_path / name))

    def fails():
        df.select(F.raise_error(F.lit("a bad row"))).collect()

    got = loads.parallel(spark, {"a": write("a"), "b": fails, "c": write("c"), "d": lambda: {}["no job"]})
    assert [(o.name, o.state) for o in got] == [("a", "done"), ("b", "failed"), ("c", "done"), ("d", "failed")]
    assert got[1].error and got[0].error is None and spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "c")).count() == 200
    assert loads.report(spark, got).filter("state = 'failed'").count() == 2 and loads.parallel(spark, {}) == []


def test_late_loads_and_those_after_a_failure_are_cancelled(spark):
    def slow():
        spark.range(2, numPartitions=2).mapInPandas(lambda it: (time.sleep(60) or pdf for pdf in it), "id long").collect()

    def fails():
        time.sleep(3)
        raise ValueError("no file")

    began = time.monotonic()
    got = loads.parallel(spark, {"slow": slow, "fails": fails, "later": slow}, at_once=2, stop_on_failure=True)
    assert [o.state for o in got] == ["cancelled", "failed", "skipped"]
    late = loads.parallel(spark, {"slow": slow, "quick": lambda: spark.range(3).count()}, most_seconds=8)
    assert [o.state for o in late] == ["cancelled", "done"] and time.monotonic() - began < 55


# The archive


def test_every_version_of_a_file_is_kept(spark, tmp_path, monkeypatch):
    s = store.Store(spark, str(tmp_path / "s"))
    files = lambda **f: spark.createDataFrame([(k, bytearray(v)) for k, v in f.items()], "file string, content binary")
    assert rows(s.sync(files(a=b"1", b=b"1", c=b""))) == [("a", "new"), ("b", "new"), ("c", "new")]
    made = {f: os.stat(tmp_path / "s/objects" / f).st_mtime_ns for f in os.listdir(tmp_path / "s/objects")}
    assert len(made) == 2  # equal contents are one
    assert rows(s.sync(files(a=b"2", b=b"1"))) == [("a", "changed"), ("b", "same")]
    real = versions.Table.commit

    def stop(self, *a):
        raise ZeroDivisionError

    monkeypatch.setattr(versions.Table, "commit", stop)
    with pytest.raises(ZeroDivisionError):
        s.sync(files(a=b"3"))
    monkeypatch.setattr(versions.Table, "commit", real)
    assert s.index().filter("file = 'a'").count() == 2
    s.sync(files(a=b"1"))
    assert {(r.file, r.version): bytes(r.content) for r in s.read().collect()} == {("a", 1): b"1", ("a", 2): b"2", ("a", 3): b"1", ("b", 1): b"1", ("c", 1): b""}
    assert made.items() <= {f: os.stat(tmp_path / "s/objects" / f).st_mtime_ns for f in os.listdir(tmp_path / "s/objects")}.items()
    with pytest.raises(ValueError, match="two contents"):
        s.sync(files(d=b"1").union(files(d=b"2")))
    assert s.sync(files(a=b"1").limit(0)).count() == 0
