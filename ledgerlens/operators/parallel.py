"""Several Spark tasks of one driver side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Fits that run side by side at most; each is many short jobs that leave cores idle.
FITS_AT_ONCE = 4


def side_by_side(spark: SparkSession, tasks: Sequence[tuple[str, Callable]], at_once: int = FITS_AT_ONCE) -> list:
    """Run ``(name, function)`` tasks in a bounded pool of threads and return their
    results in order.  A task's Spark jobs inherit the caller's job properties and
    run in a scheduler pool of the task's name, so that under
    ``spark.scheduler.mode=FAIR`` no task waits for another one's jobs.  The
    first failure, in order, is raised after all tasks have ended."""
    def in_pool(name: str, fn: Callable):
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
            return fn()
        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        futures = [pool.submit(in_pool(name, fn)) for name, fn in tasks]
    return [f.result() for f in futures]
