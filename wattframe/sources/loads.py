"""Several loads at once, each a Spark job of its own thread, and a report of what became of them."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

REPORT = "name string, state string, seconds double, error string"


@dataclass
class Outcome:
    """state: done, failed, cancelled (while it ran) or skipped (before it began)."""

    name: str
    state: str
    seconds: float
    error: str | None = None


def parallel(spark: SparkSession, loads: dict[str, Callable[[], None]], at_once: int = 4, stop_on_failure: bool = False, most_seconds: float | None = None) -> list[Outcome]:
    """Runs the loads, `at_once` at a time, waits for all of them and reports each; a failure is a report, not an exception.

    Each load's jobs bear a tag of its own. A load that takes more than most_seconds is cancelled by it; with
    stop_on_failure so are all others once one fails, and those that haven't begun are skipped. What is done stays.
    Loads write to places of their own: Spark's writers of one folder would delete each other's temporary files.
    """
    context = spark.sparkContext
    run = uuid.uuid4().hex
    stop = threading.Event()
    began: dict[str, float] = {}
    cancelled: set[str] = set()
    tag = lambda name: f"load-{run}-{list(loads).index(name)}"

    def one(name: str) -> Outcome:
        if stop.is_set():
            return Outcome(name, "skipped", 0.0)
        began[name] = time.monotonic()
        context.addJobTag(tag(name))
        try:
            loads[name]()
        except Exception as e:  # reported to the caller, whatever it is
            said = str(e).strip().split("\n")[0][:500] or type(e).__name__
            if name in cancelled:
                return Outcome(name, "cancelled", time.monotonic() - began[name], said)
            if stop_on_failure:
                stop.set()
            return Outcome(name, "failed", time.monotonic() - began[name], said)
        finally:
            context.removeJobTag(tag(name))
        return Outcome(name, "done", time.monotonic() - began[name])

    with ThreadPoolExecutor(at_once) as pool:
        target = inheritable_thread_target(spark)(one)
        futures = {pool.submit(target, name): name for name in loads}
        left = set(futures)
        while left:
            done, left = wait(left, timeout=0.2, return_when=FIRST_COMPLETED)
            for future in left:
                name = futures[future]
                late = most_seconds is not None and name in began and time.monotonic() - began[name] > most_seconds
                if name in began and name not in cancelled and (late or stop.is_set()):
                    cancelled.add(name)
                if name in cancelled:  # again until it ends: a load may start its next job
                    context.cancelJobsWithTag(tag(name))
    return [future.result() for future in futures]


def report(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(o).values()) for o in outcomes], REPORT)
