"""A stream of time ranges.

Each micro-batch is one half-open range ``[start, end)`` kept as the stream's
offset; the rows themselves are read inside the micro-batch by an ordinary
Spark scan with a range filter.  The checkpoint therefore holds everything
needed to repeat a batch exactly, and the data never passes through Python.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from sluicework.functions.dates import whole_unit_cap
from sluicework.session import register_source

UNITS = {"minutes": timedelta(minutes=1), "days": timedelta(days=1)}


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class TimeRanges(DataSource):
    """``format("time_ranges")``: ``start_ts STRING, end_ts STRING``, one row per batch.

    Options: ``start`` (ISO), ``cap`` and ``unit`` (minutes or days), and
    ``until`` to stop at a fixed time rather than follow the clock.
    """

    @classmethod
    def name(cls) -> str:
        return "time_ranges"

    def schema(self) -> str:
        return "start_ts STRING, end_ts STRING"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return TimeRangesReader(dict(self.options))


class TimeRangesReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return {"end": self.options["start"]}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """The next range after ``start``; none when it would be empty."""
        left = datetime.fromisoformat(start["end"])
        until = self.options.get("until")
        now = datetime.fromisoformat(until) if until else utc_now()
        right = whole_unit_cap(left, now, int(self.options["cap"]), UNITS[self.options["unit"]])
        end = {"end": right.isoformat()}
        rows = [] if right <= left else [(left.isoformat(), right.isoformat())]
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The same range again after a restart."""
        return iter([(start["end"], end["end"])] if start["end"] != end["end"] else [])


def range_stream(
    spark: SparkSession, start: datetime, cap: int, unit: str, until: datetime | None = None,
) -> DataFrame:
    # The process that plans a streaming source sees no shipped files, so the
    # source travels whole instead of by module name.
    for module in (sys.modules[__name__], sys.modules[whole_unit_cap.__module__]):
        cloudpickle.register_pickle_by_value(module)
    name = register_source(spark, TimeRanges)
    reader = spark.readStream.format(name).option("start", start.isoformat()).option("cap", cap).option("unit", unit)
    if until is not None:
        reader = reader.option("until", until.isoformat())
    return reader.load()


def batch_range(batch: DataFrame) -> tuple[datetime, datetime] | None:
    """The one range of a micro-batch."""
    row = batch.first()
    return (datetime.fromisoformat(row[0]), datetime.fromisoformat(row[1])) if row else None
