"""Generic dataflow operators, parameterised by column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.columns import month_index


def latest_wins(df: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order, which should be total. Plans a partial limit before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def first_and_last(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Of each value the one at the smallest and at the largest order, in one aggregate."""
    ends = [f(v, order).alias(f"{p}_{v}") for v in values for p, f in (("first", F.min_by), ("last", F.max_by))]
    return df.groupBy(*keys).agg(*ends)


def complete_grid(df: DataFrame, entity: str, time: str, step: str) -> DataFrame:
    """Every entity at every step from the first to the last time, with df's columns where it has the row."""
    ends = df.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    times = ends.select(F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias(time))
    grid = df.select(entity).distinct().crossJoin(times)
    return grid.join(df, [entity, time], "left")


def fill_forward(df: DataFrame, entity: str, time: str, value: str, most: int) -> DataFrame:
    """Nulls take the last value of up to `most` rows before; `imputed` marks them."""
    window = Window.partitionBy(entity).orderBy(time).rowsBetween(-most, -1)
    last = F.last(value, ignorenulls=True).over(window)
    return df.withColumn("__last", last).withColumn("imputed", F.col(value).isNull() & F.col("__last").isNotNull()).withColumn(value, F.coalesce(value, "__last")).drop("__last")


def interval_end(df: DataFrame, entity: str | None, start: str, fallback: Column, end: str = "end") -> DataFrame:
    """The next row's start, or the fallback after the last."""
    window = Window.partitionBy(entity) if entity else Window.partitionBy(F.lit(0))
    return df.withColumn(end, F.coalesce(F.lead(start).over(window.orderBy(start)), fallback))


def overlap_join(a: DataFrame, b: DataFrame, a_start: str, a_end: str, b_start: str, b_end: str, bucket: str = "month", calendar: bool = False) -> DataFrame:
    """Pairs of intervals [start, end) that overlap, with the overlap's ends.

    Both sides meet in buckets of time (an equi-join), and a pair counts in the bucket where its overlap starts, so that long
    intervals neither multiply rows nor need a nested loop. Where b is a calendar (its rows are bounded by time, not by the
    data), it is broadcast: a's rows, one for each bucket that they touch, are then never shuffled.
    """
    cut = lambda c: F.date_trunc(bucket, F.col(c)).cast("timestamp_ntz")
    spread = lambda df, s, e: df.filter(F.col(s) < F.col(e)).withColumn("__bucket", F.explode(F.sequence(cut(s), cut(e), F.expr(f"interval 1 {bucket}"))))
    other = spread(b, b_start, b_end)
    met = spread(a, a_start, a_end).join(F.broadcast(other) if calendar else other, "__bucket")
    met = met.withColumn("overlap_start", F.greatest(a_start, b_start)).withColumn("overlap_end", F.least(a_end, b_end))
    return met.filter((F.col("overlap_start") < F.col("overlap_end")) & (cut("overlap_start") == F.col("__bucket"))).drop("__bucket")


def same_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a whose keys b has too."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_semi")


def known_at(history: DataFrame, origins: DataFrame, month: str, origin: str = "origin", keys: Sequence[str] = ()) -> DataFrame:
    """Each origin with the history up to and with its month. Origins are few and meet the history's own keys first."""
    if keys:
        return origins.join(history, list(keys)).filter(F.col(month) <= F.col(origin))
    return origins.crossJoin(history).filter(F.col(month) <= F.col(origin))


def carry_forward(df: DataFrame, wanted: DataFrame, key: str, value: str) -> DataFrame:
    """Values of wanted keys; after the last known key its value, flagged as assumed. Keys before that stay null."""
    last = df.agg(F.max(key).alias("__k"), F.max_by(value, key).alias("__v"))
    return wanted.join(df, key, "left").crossJoin(last).withColumn("assumed", F.col(key) > F.col("__k")).withColumn(value, F.when(F.col("assumed"), F.col("__v")).otherwise(F.col(value))).drop("__k", "__v")


def closing_run(df: DataFrame, entity: str, time: str, flag: str, n: int) -> DataFrame:
    """First time of each entity at which the flag holds n rows in a row; a missing next row counts as false."""
    window = Window.partitionBy(entity).orderBy(time)
    run = F.col(flag)
    for i in range(1, n):
        run = run & F.coalesce(F.lead(flag, i).over(window), F.lit(False))
    return df.withColumn("__run", run).filter("__run").groupBy(entity).agg(F.min(time).alias("closed_at"))


def version_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str, label: str, tolerance: float = 1e-6) -> DataFrame:
    """What changed between two versions of a file, row by row: class, and both values.

    Classes: added, removed, renamed (the label differs), null_to_value, value_to_null, changed (by more than the
    tolerance), noise (by less), same.
    """
    a = old.select(*keys, F.col(value).alias("old_value"), F.col(label).alias("old_label"), F.lit(True).alias("in_old"))
    b = new.select(*keys, F.col(value).alias("new_value"), F.col(label).alias("new_label"), F.lit(True).alias("in_new"))
    x, y = F.col("old_value"), F.col("new_value")
    kind = (
        F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed")
        .when(x.isNull() & y.isNotNull(), "null_to_value").when(x.isNotNull() & y.isNull(), "value_to_null")
        .when(F.abs(x - y) > tolerance, "changed").when(~F.col("old_label").eqNullSafe(F.col("new_label")), "renamed").when(x != y, "noise").otherwise("same")
    )
    return a.join(b, list(keys), "full").select(*keys, "old_value", "new_value", kind.alias("change"))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """Keys on one side only, or whose values differ by more than the tolerance."""
    both = a.select(*keys, F.col(value).alias("left_value")).join(b.select(*keys, F.col(value).alias("right_value")), list(keys), "full")
    return both.filter(F.col("left_value").isNull() | F.col("right_value").isNull() | (F.abs(F.col("left_value") - F.col("right_value")) > tolerance))


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that the source doesn't replace, and the source. Source keys must be unique and not null."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def rolling_pairs(months: DataFrame, month: str, horizons: int = 12) -> DataFrame:
    """origin, horizon and target month for every origin."""
    return months.select(F.col(month).alias("origin"), F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("horizon")).withColumn("target", F.add_months("origin", F.col("horizon")))


def contiguous_blocks(df: DataFrame, month: str, value: str, size: int = 12) -> DataFrame:
    """Every run of `size` contiguous months, as its first month and an array of values in order."""
    window = Window.partitionBy(F.lit(0)).orderBy(month).rowsBetween(0, size - 1)
    months = F.collect_list(F.struct(month, value)).over(window)
    whole = (F.size("__b") == size) & (month_index(F.col("__b")[size - 1][month]) - month_index(F.col("__b")[0][month]) == size - 1)
    return df.withColumn("__b", months).filter(whole).select(F.col("__b")[0][month].alias("block"), F.transform("__b", lambda x: x[value]).alias("values"))
