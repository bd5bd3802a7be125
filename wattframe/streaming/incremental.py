"""Incremental reloads of partitioned tables whose raw months are local and whose target months are UTC.

A reload names local months. Its UTC partitions are all that the local interval touches; they are replaced as wholes, so
what is read must cover them: the local months of their first and their last hour. Nothing here reads a clock.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators.relational import version_diff
from wattframe.sources import sinks


def shift(month: date, n: int) -> date:
    years, at = divmod(month.month - 1 + n, 12)
    return date(month.year + years, at + 1, 1)


def span(first: date, last: date) -> list[date]:
    n = (last.year - first.year) * 12 + last.month - first.month
    return [shift(first.replace(day=1), k) for k in range(n + 1)]


@dataclass(frozen=True)
class Reload:
    """Local months, both ends included."""

    first: date
    last: date
    zone: str = C.ZONE

    def __post_init__(self) -> None:
        if self.first.day != 1 or self.last.day != 1 or self.first > self.last:
            raise ValueError("months must be first days, in order")

    def _utc(self, month: date) -> datetime:
        return datetime(month.year, month.month, 1, tzinfo=ZoneInfo(self.zone)).astimezone(UTC)

    @property
    def local_months(self) -> list[date]:
        return span(self.first, self.last)

    @property
    def partitions(self) -> list[date]:
        """UTC months that the local interval touches."""
        final = self._utc(shift(self.last, 1)) - timedelta(seconds=1)
        return span(self._utc(self.first).date().replace(day=1), final.date().replace(day=1))

    @property
    def bounds(self) -> tuple[datetime, datetime]:
        """Start (included) and end (excluded) of these UTC months."""
        months = self.partitions
        at = lambda m: datetime(m.year, m.month, 1, tzinfo=UTC)
        return at(months[0]), at(shift(months[-1], 1))

    @property
    def read_months(self) -> list[date]:
        """Local months of raw data that these UTC months need."""
        start, end = self.bounds
        local = lambda t: t.astimezone(ZoneInfo(self.zone)).date().replace(day=1)
        return span(local(start), local(end - timedelta(hours=1)))

    def check(self, raw_months: Iterable[date]) -> None:
        """Raises unless the raw table has every month between its own ends that is to be read."""
        have = set(raw_months)
        if not have:
            raise ValueError("the raw table is empty")
        gaps = [m for m in self.read_months if min(have) <= m <= max(have) and m not in have]
        if gaps:
            raise ValueError(f"raw months are missing: {gaps[:3]}")


def usual_reload(reference: date, last_raw: date | None, months: int = 3, zone: str = C.ZONE) -> Reload:
    """The reference's month and those before it, back to the last raw month if that is earlier."""
    last = reference.replace(day=1)
    first = shift(last, 1 - months)
    return Reload(min(first, last_raw) if last_raw else first, last, zone)


def backfill(first: date, last: date, zone: str = C.ZONE) -> Reload:
    """An explicit range, widened to whole months."""
    return Reload(first.replace(day=1), last.replace(day=1), zone)


def reload_table(spark: SparkSession, raw: DataFrame, path: str, window: Reload, stage: Callable[[DataFrame], DataFrame], local: str = "local", utc: str = "utc") -> None:
    """Stages the raw months a window needs and replaces its UTC partitions (column `month`)."""
    months = [F.lit(m.isoformat()).cast("date") for m in window.read_months]
    start, end = (F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz") for t in window.bounds)
    staged = stage(raw.filter(C.month_of(local).isin(*months))).filter((F.col(utc) >= start) & (F.col(utc) < end))
    staged = staged.withColumn("month", F.date_format(C.month_of(utc), "yyyy-MM-dd"))
    sinks.replace_partitions(staged, path, "month", [m.isoformat() for m in window.partitions])


def must_reload(old: DataFrame, new: DataFrame, keys: list[str], value: str, label: str, local: str, window: Reload) -> bool:
    """Whether versions differ outside the window, so that the whole file has to be loaded again."""
    changes = version_diff(old, new, keys, value, label).filter(~F.col("change").isin("same", "noise"))
    inside = [F.lit(m.isoformat()).cast("date") for m in window.local_months]
    return not changes.filter(~C.month_of(local).isin(*inside)).isEmpty()


def affected_months(old: DataFrame, new: DataFrame, keys: list[str], value: str, label: str, local: str) -> DataFrame:
    return version_diff(old, new, keys, value, label).filter(~F.col("change").isin("same", "noise")).groupBy(C.month_of(local).alias("month"), "change").agg(F.count("*").alias("n"))


def descendants(edges: dict[str, list[str]], source: str) -> list[str]:
    """What has to be built again after a source changed, parents first."""
    reach, todo = {source}, [source]
    while todo:
        for child in edges.get(todo.pop(), []):
            if child not in reach:
                reach.add(child)
                todo.append(child)
    order: list[str] = []
    waiting = {n: {p for p, cs in edges.items() if n in cs and p in reach} for n in reach}
    while waiting:
        ready = sorted(n for n, ps in waiting.items() if ps <= set(order))
        if not ready:
            raise ValueError("the tables depend on one another in a circle")
        order += ready
        for n in ready:
            del waiting[n]
    return order


def stream_table(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str, stage: Callable[[DataFrame], DataFrame], utc: str = "utc"):
    """A file stream that appends staged rows by UTC month: each micro-batch replaces its own earlier attempt.

    The batch number is part of the partition, so a batch that runs again after a failure overwrites what it wrote.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = stage(batch).withColumn("month", F.date_format(C.month_of(utc), "yyyy-MM")).withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(path)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
