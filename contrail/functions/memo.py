"""Reuse of built column expressions within one SparkContext.

A ``Column`` is an immutable, unresolved expression tree; building a wide
projection costs thousands of driver-to-JVM calls. Projections that are the
same on every call are built once per SparkContext and reused (DataFrames
are never cached here, so every query still reads its tables afresh).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import SparkContext

_CACHE: dict[tuple, Any] = {}


def memo(key: tuple, build: Callable[[], Any]) -> Any:
    sc = SparkContext._active_spark_context
    full = (id(sc), sc.applicationId if sc is not None else None) + key
    if full not in _CACHE:
        _CACHE[full] = build()
    return _CACHE[full]
