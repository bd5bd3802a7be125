"""One run at a time: an exclusive lock with an owner and a lease, as files in a shared folder.

Taking the lock creates the file of the next number exclusively; the highest number holds it. A lease that ran out without being
renewed is taken over by the next number, which only one of several runs can create. A holder that was taken over finds a
higher number than its own and must not write any more. Clocks of the machines may differ by less than the lease.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.sources.sinks import exists
from wattframe.sources.versions import content, numbers, publish


class Locked(RuntimeError):
    """Another run holds the lock, or took it over."""


class RunLock:
    def __init__(self, spark: SparkSession, path: str, owner: str, lease: float = 3600.0, clock: Callable[[], float] = time.time) -> None:
        self.spark, self.path, self.owner, self.lease, self.clock = spark, path.rstrip("/"), owner, lease, clock
        self.number: int | None = None
        self.renewed = 0

    def holder(self) -> tuple[int, str | None, float]:
        """The highest number, its owner (None once released) and the end of its lease."""
        n = max(numbers(self.spark, self.path, "lock-"), default=0)
        if not n or exists(self.spark, f"{self.path}/released-{n}"):
            return n, None, 0.0
        renewals = numbers(self.spark, self.path, f"renewal-{n}-")
        found = json.loads(content(self.spark, f"{self.path}/{f'renewal-{n}-{renewals[-1]}' if renewals else f'lock-{n}'}"))
        return n, found["owner"], found["until"]

    def _terms(self) -> str:
        return json.dumps({"owner": self.owner, "until": self.clock() + self.lease})

    def acquire(self) -> None:
        n, owner, until = self.holder()
        if owner is not None and self.clock() < until:
            raise Locked(f"{owner} holds {self.path}")
        if not publish(self.spark, f"{self.path}/lock-{n + 1}", self._terms()):
            raise Locked(f"another run took {self.path} just now")
        self.number, self.renewed = n + 1, 0

    def check(self) -> None:
        """Raises unless this run still holds the lock; to be called before every write that others see."""
        n, owner, until = self.holder()
        if self.number is None or n != self.number or owner is None or self.clock() >= until:
            raise Locked(f"{self.owner} no longer holds {self.path}")

    def renew(self) -> None:
        self.check()
        self.renewed += 1
        if not publish(self.spark, f"{self.path}/renewal-{self.number}-{self.renewed}", self._terms()):
            raise Locked(f"{self.path} was renewed by another")

    def release(self) -> None:
        if self.number is not None:
            publish(self.spark, f"{self.path}/released-{self.number}", self.owner)
            self.number = None


@contextmanager
def held(spark: SparkSession, path: str, owner: str, lease: float = 3600.0, clock: Callable[[], float] = time.time) -> Iterator[RunLock]:
    lock = RunLock(spark, path, owner, lease, clock)
    lock.acquire()
    try:
        yield lock
    finally:
        lock.release()


class Moved(ValueError):
    """An input differs from the frozen one."""


def check_frozen(now: DataFrame, frozen: DataFrame) -> None:
    """Raises if an input's fingerprint (input, h) differs from the frozen one, or either has one input more."""
    both = now.alias("n").join(frozen.withColumnRenamed("h", "f"), "input", "full").filter(~F.col("h").eqNullSafe(F.col("f")))
    moved = [r.input for r in both.select("input").limit(20).collect()]
    if moved:
        raise Moved(f"inputs differ from the frozen ones: {', '.join(sorted(moved))}")


def frozen_run(spark: SparkSession, path: str, owner: str, fingerprints: Callable[[], DataFrame], work: Callable[[RunLock], None], lease: float = 3600.0, clock: Callable[[], float] = time.time) -> DataFrame:
    """Does the work while holding the lock at the path, on inputs that stay as they were when first frozen there.

    The first run freezes the inputs' fingerprints; later ones are refused if theirs differ. They are looked at again after
    the work: a run whose inputs moved meanwhile fails. Returns the frozen fingerprints.
    """
    with held(spark, f"{path}/lock", owner, lease, clock) as lock:
        where = f"{path}/frozen"
        if not exists(spark, f"{where}/_SUCCESS"):
            fingerprints().coalesce(1).write.mode("overwrite").parquet(where)
        frozen = spark.read.schema("input string, h string").parquet(where)
        check_frozen(fingerprints(), frozen)
        work(lock)
        lock.check()
        check_frozen(fingerprints(), frozen)
        return frozen
