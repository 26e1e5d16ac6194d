"""Extensions: named bundles of functions that a session loads from a Python module."""

from __future__ import annotations

import importlib

from pyspark.sql import SparkSession

API_LEVEL = 1


def load(spark: SparkSession, module: str, allow_unstable: bool = False) -> None:
    """Loads the module and calls its register(spark). Its API_LEVEL must not be above ours; one that says UNSTABLE = True is loaded only if that is allowed."""
    m = importlib.import_module(module)
    if getattr(m, "API_LEVEL", 0) > API_LEVEL:
        raise ImportError(f"{module} needs API level {m.API_LEVEL}; this is {API_LEVEL}")
    if getattr(m, "UNSTABLE", False) and not allow_unstable:
        raise ImportError(f"{module} uses what may change; load it with allow_unstable=True")
    m.register(spark)
