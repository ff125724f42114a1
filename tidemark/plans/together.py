"""Independent Spark jobs submitted side by side, so that one's last tasks do not leave the
executors idle while the next one waits."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Results of ``actions`` in order. The first failure raises once all have ended."""
    if not actions:
        return []
    with ThreadPoolExecutor(len(actions)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [future.result() for future in futures]
