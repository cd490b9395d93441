"""Bounded models and tables for the tasks of a job."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame


def share(df: DataFrame, value: Any) -> Callable[[], Any]:
    """Broadcast ``value``; the function returned gives it to a task of ``df``, with its class if executors lack it."""
    held = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)
