"""Results that are gone on with: what is computed again, what counts, and what doesn't."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from wattframe.operators import resumable
from wattframe.plans import fitted


def counted(spark):
    count = spark.sparkContext.accumulator(0)

    def compute(keys):
        def run(batches):
            for pdf in batches:
                count.add(len(pdf))
                yield pdf.assign(value=pdf.n * 10.0)

        return keys.mapInPandas(run, "model string, n int, value double")

    return compute, count


def test_a_stopped_run_is_gone_on_with(spark, tmp_path):
    path, keys = str(tmp_path / "r"), ["model", "n"]
    todo = spark.createDataFrame([(m, n) for m in "ab" for n in range(20)], "model string, n int")
    compute, count = counted(spark)

    class Stop(Exception):
        pass

    calls = []

    def stops(part):
        calls.append(1)
        if len(calls) == 3:
            raise Stop
        return compute(part)

    with pytest.raises(Stop):
        resumable.resume(todo, keys, path, stops, batches=4)
    done = {(r.model, r.n) for r in resumable.finished(todo, keys, path).collect()}
    assert 0 < len(done) == count.value < 40
    # Rows of a batch that was written, but not marked, are no results.
    todo.limit(3).withColumn("value", F.lit(-1.0)).write.parquet(f"{path}/rows/write=0dead")
    assert {(r.model, r.n) for r in resumable.results(todo, keys, path, "model string, n int, value double").collect()} == done
    out = resumable.resume(todo, keys, path, compute, batches=4)
    assert sorted(map(tuple, out.collect())) == sorted((m, n, n * 10.0) for m in "ab" for n in range(20))
    assert count.value == 40  # the second run computed the others alone
    again = resumable.resume(todo, keys, path, compute, batches=2)
    assert again.count() == 40 and count.value == 40
    # A key that two runs did counts once.
    todo.filter("n = 1").withColumn("value", F.col("n") * 10.0).write.parquet(f"{path}/rows/write=zz")
    todo.filter("n = 1").withColumn("write", F.lit("zz")).write.mode("append").parquet(f"{path}/done")
    assert resumable.resume(todo, keys, path, compute, batches=2).count() == 40
    more = todo.union(spark.createDataFrame([("c", 1)], "model string, n int"))
    assert resumable.resume(more, keys, path, compute, batches=2).count() == 41 and count.value == 41


def test_null_keys_and_empty_lists(spark, tmp_path):
    compute, count = counted(spark)
    todo = spark.createDataFrame([(None, 1)], "model string, n int")
    with pytest.raises(ValueError):
        resumable.resume(todo, ["model", "n"], str(tmp_path / "a"), compute)
    assert resumable.resume(todo.limit(0), ["model", "n"], str(tmp_path / "b"), compute).count() == 0 and count.value == 0


def test_fits_are_gone_on_with(spark, tmp_path):
    s = spark.createDataFrame([(date(2000 + k // 12, k % 12 + 1, 1), 24000 + k, 100.0 + k % 12 + k) for k in range(44)], "month date, mi int, value double")
    path = str(tmp_path / "fits")
    first = fitted.resumed_rows(spark, s, path, "2002-12-01", ["ridge", "boosted"], months=30, batches=2)
    assert {r.origin for r in first.select("origin").distinct().collect()} == {date(2002, m, 1) for m in range(6, 13)}
    writes = {r.write for r in resumable.finished(first, ["model", "origin"], path).collect()}
    out = fitted.resumed_rows(spark, s, path, names=["ridge", "boosted"], months=30, batches=2)
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(out) == order(fitted.model_rows(spark, s, ["ridge", "boosted"], 30))
    early = resumable.finished(out, ["model", "origin"], path).filter("origin <= date'2002-12-01'")
    assert {r.write for r in early.collect()} == writes
