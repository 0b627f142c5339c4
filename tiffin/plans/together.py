"""Independent tables built at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

AT_ONCE = 4


def run_together(
    spark: SparkSession,
    build: Callable[[Item], Result],
    items: Iterable[Item],
    at_once: int = AT_ONCE,
) -> list[Result]:
    """``build`` of each item, in order, with up to ``at_once`` Spark jobs at a time.

    Small tables then run beside a large one, on executors that its last tasks leave idle. The first
    error is raised; items not yet begun by then are left out.
    """
    if at_once == 1:
        return [build(item) for item in items]
    with ThreadPoolExecutor(at_once) as pool:
        target = inheritable_thread_target(spark)(build)
        futures = [pool.submit(target, item) for item in items]
        wait(futures, return_when=FIRST_EXCEPTION)
        pool.shutdown(wait=False, cancel_futures=True)
        failed = [f for f in futures if f.done() and not f.cancelled() and f.exception()]
        return [future.result() for future in failed or futures]
