"""Sinks by action name: ``sink(df, batch_id, properties)``."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from sluicework.registry import Registry

Sink = Callable[[DataFrame, object, Mapping[str, str]], None]

SINKS = Registry("sink action")


def action_name(properties: Mapping[str, str]) -> str:
    """``action`` or the last part of ``action_class``."""
    return properties.get("action") or properties["action_class"].rsplit(".", 1)[-1]


def with_retry(write: Callable[[], None], attempts: int = 2, wait_seconds: float = 2.0) -> None:
    """Run a write, wait and run it again on failure, then give up."""
    for attempt in range(1, attempts + 1):
        try:
            write()
            return
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(wait_seconds)


def write_output(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """Send a frame to the sink its properties name."""
    sink = SINKS.get(action_name(properties))
    attempts = int(properties.get("sink_attempts", "1"))
    with_retry(
        lambda: sink(df, batch_id, properties),
        attempts,
        float(properties.get("sink_retry_wait", "2")),
    )
