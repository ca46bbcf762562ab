"""Spark's Python workers: makes this package importable there, wherever the driver was started, and bounds what they keep."""

from __future__ import annotations

import ctypes
import functools
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession

# What operators keep in this Python worker from task to task.
_KEPT: dict[tuple, Any] = {}


def kept(owner: tuple, make: Callable[[], Any]) -> Any:
    """What an operator keeps in this Python worker for its next tasks; what others have kept there goes."""
    if owner not in _KEPT:
        let_go()
        _KEPT[owner] = make()
    return _KEPT[owner]


def let_go() -> None:
    """Frees what an operator of an earlier stage has kept: a worker serves many stages, and would hold it through them all."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Returns freed memory to the system, which the allocators would hold for this worker alone."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def tidy(rows: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same rows of a task, whose worker then gives back what it has freed: it waits beside the JVM, for stages maybe."""

    @functools.wraps(rows)
    def run(batches):
        yield from rows(batches)
        give_back()

    return run


def send_package(spark: SparkSession) -> None:
    """Sends the package to the executors, once per application. Spark hands the file on from the driver."""
    _send(spark.sparkContext.applicationId, spark)


@functools.lru_cache(maxsize=8)
def _send(_application: str, spark: SparkSession) -> None:
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
