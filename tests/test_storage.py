import datetime as dt
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattframe.sources import sinks, text, versions
from wattframe.streaming import incremental, landing


@pytest.mark.parametrize("size", [1, 2, 3])
@pytest.mark.parametrize("start", [date(2016, 10, 1), date(2017, 1, 1), date(2019, 2, 1), date(2021, 12, 1)])
def test_windows_cover_what_they_replace(start, size):
    w = incremental.Reload(start, incremental.shift(start, size - 1))
    assert set(w.local_months) <= set(w.read_months)
    lo, hi = w.bounds
    assert lo <= w._utc(w.first) and w._utc(incremental.shift(w.last, 1)) <= hi
    assert [m.day for m in w.partitions] == [1] * len(w.partitions)


def test_window_refuses_gaps():
    with pytest.raises(ValueError, match="missing"):
        incremental.Reload(date(2024, 1, 1), date(2024, 3, 1)).check([date(2023, 12, 1), date(2024, 1, 1), date(2024, 4, 1)])


def test_partition_guards(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, m string")
    sinks.replace_table(df, path, "m")
    with pytest.raises(sinks.PartitionError):
        sinks.replace_partitions(df, path, "m", ["a"])
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(sinks.PartitionError):
        sinks.check_partitioned(spark, path, "other")
    sinks.replace_partitions(df.filter("m = 'a'"), path, "m", ["a", "b"])
    assert sinks.partitions(spark, path, "m") == ["a"]
    with pytest.raises(sinks.PartitionError):
        sinks.drop_partitions(spark, path, "m", ["../x"])


def test_snapshots_are_small(spark):
    df = spark.createDataFrame([(2, None, 0.5), (1, "a", 2.0)], "k int, v string, x double")
    assert sinks.csv_text(df, ["k"]) == "k,v,x\n1,a,2.0\n2,,0.5\n"
    with pytest.raises(ValueError, match="more than 1"):
        sinks.csv_text(df, ["k"], most_rows=1)


def test_delimited_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Mês;Valor\n01;\n1;2,5\n", encoding="utf-8")
    got = text.read_delimited(spark, str(tmp_path / "a.csv"), ["Mês", "Valor"]).drop("source_file").collect()
    assert [tuple(r) for r in got] == [("01", ""), ("1", "2,5")]
    with pytest.raises(Exception, match="header|column"):
        text.read_delimited(spark, str(tmp_path / "a.csv"), ["Mês", "Outro"]).collect()
    (tmp_path / "b.csv").write_text("Mês;Valor\n1;2;3\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        text.read_delimited(spark, str(tmp_path / "b.csv"), ["Mês", "Valor"]).collect()
    with pytest.raises(text.LayoutError):
        text.header_names(["a b", "A-B"])


def test_rebuild_order():
    assert incremental.descendants({"a": ["b", "c"], "b": ["d"], "c": ["d"]}, "a") == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="circle"):
        incremental.descendants({"a": ["b"], "b": ["a"]}, "a")


def test_local_months_of_a_reload():
    w = incremental.usual_reload(date(2024, 1, 15), date(2023, 9, 1))
    assert (w.first, w.last) == (date(2023, 9, 1), date(2024, 1, 1))
    assert w.bounds == (dt.datetime(2023, 9, 1, tzinfo=dt.UTC), dt.datetime(2024, 3, 1, tzinfo=dt.UTC))


def test_a_failed_load_leaves_the_state(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    area = landing.Landing(spark, str(folder), str(tmp_path / "state"))
    put = lambda name, text, at: ((folder / name).write_text(text), os.utime(folder / name, (at, at)))
    seen = []
    note = lambda files: seen.append(sorted((r.file, r.kind) for r in files.collect()))
    put("2023.csv", "a", 1000)
    put("2024.csv", "b", 1000)

    def fails(files):
        note(files)
        raise ZeroDivisionError

    with pytest.raises(ZeroDivisionError):
        area.load(fails)
    assert area.state().count() == 0
    area.load(note)
    assert seen == [[("2023.csv", "new"), ("2024.csv", "new")]] * 2
    area.load(note)
    put("2023.csv", "a", 2000)  # served anew, the same contents: its digest leaves it out
    put("2024.csv", "bb", 2000)
    with pytest.raises(ZeroDivisionError):
        area.load(fails)
    got = sorted(map(tuple, area.load(note, F.col("file") < "2024").collect()))
    assert got == [("2023.csv", "touched"), ("2024.csv", "changed")] and seen[2:] == [[("2024.csv", "changed")]] * 2
    put("2023.csv", "other", 3000)
    with pytest.raises(ValueError, match="2023"):
        area.load(note, F.col("file") < "2024")
    assert len(seen) == 4 and area.table.version() == 2


def test_two_loads_at_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("1")
    one, two = (landing.Landing(spark, str(tmp_path / "in"), str(tmp_path / "state")) for _ in range(2))
    with pytest.raises(versions.Conflict):
        one.load(lambda files: two.load(lambda more: None))
    assert one.state().count() == 1
