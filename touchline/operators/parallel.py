"""Run independent Spark actions side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *actions: Callable) -> list:
    """The results of actions that do not depend on one another. Each runs from its own
    thread, so that one's small final stages do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=len(actions)) as threads:
        inherit = inheritable_thread_target(spark)
        futures = [threads.submit(inherit(action)) for action in actions]
        return [future.result() for future in futures]
