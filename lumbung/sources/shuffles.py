"""What a step has shuffled goes when the step ends.

Spark keeps the shuffle files of a query until the driver happens to collect the query as garbage.
In a job that writes several large tables those of all of them would lie on disk together, though
a written table needs none of its own any more.  Within ``freed_shuffles`` Spark removes a query's
files when that query ends; one that is run again later computes them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = Lock()
_running = 0
_before: str | None = None


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """For the queries that run inside.  Steps may overlap in threads; the last one restores the setting."""
    global _running, _before
    with _lock:
        if _running == 0:
            _before = spark.conf.get(SETTING, None)
            spark.conf.set(SETTING, "true")
        _running += 1
    try:
        yield
    finally:
        with _lock:
            _running -= 1
            if _running == 0 and _before is None:
                spark.conf.unset(SETTING)
            elif _running == 0:
                spark.conf.set(SETTING, _before)
