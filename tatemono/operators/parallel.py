"""Independent Spark jobs submitted side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], T]], at_once: int | None = None) -> list[T]:
    """Results of all steps, each run in a thread that keeps the session's
    job settings; the cluster's free cores then serve several small jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(at_once or len(steps), len(steps)))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [future.result() for future in futures]
