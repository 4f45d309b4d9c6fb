"""Tables read by change timestamp, and the per-trigger range of their streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.functions.dates import last_days_start, parse_text
from sluicework.operators import timerange
from sluicework.plans.spec import column_list, first_of, flag
from sluicework.session import shared_dir
from sluicework.sources.core import SOURCES
from sluicework.sources.fetched import read_range
from sluicework.sources.stores import read_jdbc_ranges

DEFAULT_COLUMN = "systemmodstamp"

# How far before now a stream without a given time starts.
POLICY_LAGS = {"latest": timedelta(seconds=5), "last_minute": timedelta(minutes=1)}


def requested_range(properties: Mapping[str, str], now: datetime | None = None) -> tuple[datetime | None, datetime | None]:
    """``last_n_days`` (open end) wins over ``start_time`` / ``end_time``."""
    if "last_n_days" in properties:
        return last_days_start(int(properties["last_n_days"]), now), None
    start, end = properties.get("start_time"), properties.get("end_time")
    return (parse_text(start) if start else None), (parse_text(end) if end else None)


def base_scan(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """The whole table as a lazy scan: a file table or a JDBC table."""
    if "path" in properties:
        df = spark.read.format(properties.get("file_format", "parquet")).load(properties["path"])
    else:
        options = {k: properties[k] for k in ("url", "driver", "user", "password") if properties.get(k)}
        df = spark.read.format("jdbc").options(**options).option("dbtable", properties["table"]).load()
    columns = column_list(properties.get("columns"))
    return df.select(*columns) if columns else df


def offset_column(df: DataFrame, properties: Mapping[str, str]) -> str:
    """The change column as the table spells it; a missing column is an error."""
    wanted = first_of(properties, "offset_column", "ts_col", default=DEFAULT_COLUMN)
    for name in df.columns:
        if name.lower() == wanted.lower():
            return name
    raise ValueError(f"column not found in schema: '{wanted}'")


def range_rows(
    df: DataFrame, properties: Mapping[str, str], start: datetime | None, end: datetime | None,
) -> DataFrame:
    column = offset_column(df, properties)
    return df.filter(timerange.range_predicate(df, column, start, end, properties.get("condition")))


@SOURCES.register("sfdc", "changes")
def read_changes(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Rows of the requested range, in buckets when they outnumber ``buffer_size``."""
    start, end = requested_range(properties)
    df = base_scan(spark, properties)
    column = offset_column(df, properties)
    rows = range_rows(df, properties, start, end)
    buffer_size = int(properties.get("buffer_size", "20000"))
    bulk = flag(properties, "bulk")
    if "path" in properties:
        return timerange.extract(rows, column, buffer_size, shared_dir(spark, "buckets"), bulk)
    if not (bulk or rows.count() > buffer_size):
        return rows
    ranges = timerange.bucket_ranges(timerange.bucket_plan(rows.select(column), column, buffer_size), end)
    predicates = timerange.range_predicates(ranges, column, start, end, properties.get("condition"))
    return read_jdbc_ranges(spark, properties, properties["table"], predicates).select(*rows.columns)


def starting_point(
    scan: Callable[[], DataFrame], properties: Mapping[str, str], now: datetime, default: str = "earliest",
) -> datetime | None:
    """Start of a new stream: smallest value, just before now, or a given time.

    An empty table under ``earliest`` has no start yet.
    """
    policy = first_of(properties, "starting_offset", "startingOffsets", default=default)
    if policy in POLICY_LAGS:
        return now - POLICY_LAGS[policy]
    if policy != "earliest":
        return parse_text(policy)
    return _lowest(scan(), properties)


def _lowest(df: DataFrame, properties: Mapping[str, str]) -> datetime | None:
    lowest = df.agg(F.min(offset_column(df, properties))).first()[0]
    return lowest if lowest is None or isinstance(lowest, datetime) else parse_text(str(lowest))


def earliest_before(spark: SparkSession, properties: Mapping[str, str], end: datetime) -> datetime | None:
    """The smallest change time before ``end``."""
    df = base_scan(spark, properties)
    return _lowest(df.filter(timerange.range_predicate(df, offset_column(df, properties), None, end)), properties)


def rows_between(
    spark: SparkSession, properties: Mapping[str, str], start: datetime, end: datetime,
) -> DataFrame:
    """Rows of one range of a stream.

    From a fetcher, from the table by range filter, or (``support_parallel_fetch``)
    from the table in buckets.
    """
    if "fetcher" in properties:
        return read_range(spark, {**properties, "start": start.isoformat(), "end": end.isoformat()})
    if flag(properties, "support_parallel_fetch"):
        bounds = {"start_time": start.isoformat(), "end_time": end.isoformat()}
        return read_changes(spark, {**properties, **bounds})
    return range_rows(base_scan(spark, properties), properties, start, end)
