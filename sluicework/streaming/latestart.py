"""Streams of time ranges that start on an empty table.

Such a stream has no start yet.  Its ranges follow the clock all the same, but their
lower bounds do not count until a batch finds rows: that batch reads from the
earliest row on, in pieces no longer than the stream's cap, and every later batch
reads its own range.  The number of that batch is kept in the checkpoint folder, so
it reads the same when it is repeated, and a restart goes on in the same state.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from sluicework.functions.dates import whole_unit_cap
from sluicework.session import path_exists, read_text, write_text

Bounds = tuple[datetime, datetime]


def tiles(start: datetime, end: datetime, cap: int, unit: timedelta) -> list[Bounds]:
    """``[start, end)`` in pieces of at most the cap."""
    found = []
    while start < end:
        stop = whole_unit_cap(start, end, cap, unit)
        found.append((start, stop))
        start = stop
    return found


class LateStart:
    def __init__(self, spark: SparkSession, checkpoint: str, empty: bool) -> None:
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}/start.json"
        if empty and read_text(spark, self.path) is None and not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
            write_text(spark, self.path, json.dumps({"resolved": None}))

    def bounds(self, batch_id: int, left: datetime, right: datetime, cap: int, unit: timedelta,
               lowest: Callable[[datetime], datetime | None]) -> list[Bounds]:
        """The ranges a batch reads; ``lowest`` gives the earliest time before a bound."""
        told = read_text(self.spark, self.path)
        resolved = json.loads(told)["resolved"] if told else -1
        if resolved is not None and batch_id > resolved:
            return [(left, right)]
        first = lowest(right)
        if first is None:
            return []
        write_text(self.spark, self.path, json.dumps({"resolved": batch_id}))
        return tiles(first, right, cap, unit)
