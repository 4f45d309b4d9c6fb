"""Lookup enrichment with children, counts and failures, and delayed retry."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.text import pack, unpack
from sluicework.operators.skew import lookup_join

MAX_ATTEMPT = 3
RETRY_DELAY = "INTERVAL 2 MINUTES"

# Fixed value: the text fields of one child record, parent id included.
CHILD_FIELDS = (
    "joinTime", "ipAddress", "device", "id", "participantUserId", "userId",
    "userName", "audioQuality", "videoQuality", "meetingId", "location",
)


def flatten_children(df: DataFrame, array_column: str, parent_id: str, fields: Sequence[str] = CHILD_FIELDS,
                     parent_field: str = "meetingId") -> DataFrame:
    """Explode child structs; missing fields become ``""``, the parent id is added."""
    child = df.select(F.col(parent_id).alias("_parent"), F.explode(array_column).alias("_child"))
    present = {f.name for f in child.schema["_child"].dataType.fields}
    columns = []
    for name in fields:
        if name == parent_field:
            value = F.col("_parent").cast("string")
        elif name in present:
            value = F.col(f"_child.{name}").cast("string")
        else:
            value = F.lit(None).cast("string")
        columns.append(F.coalesce(value, F.lit("")).alias(name))
    return child.select(*columns)


def children_of(requests: DataFrame, lookup: DataFrame, request_key: str, lookup_key: str) -> DataFrame:
    """Lookup rows that belong to a request, each carrying the request columns.

    Children are the large side and may pile up on one parent; requests are
    unique by key, so this is a lookup join from the child side.
    """
    keyed = lookup.withColumnRenamed(lookup_key, request_key)
    return lookup_join(keyed, requests, [request_key])


def child_counts(requests: DataFrame, lookup: DataFrame, request_key: str, lookup_key: str) -> DataFrame:
    """Requests with ``child_count`` (0 when nothing was found).

    Children are counted before the join, so both sides hold one row per key.
    """
    counts = lookup.groupBy(F.col(lookup_key).alias(request_key)).agg(F.count(F.lit(1)).alias("child_count"))
    joined = requests.join(counts, request_key, "left")
    return joined.withColumn("child_count", F.coalesce("child_count", F.lit(0)))


def child_messages(children: DataFrame) -> DataFrame:
    return children.select(
        F.lit("device").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in children.columns])).alias("value"),
    )


def count_messages(counted: DataFrame, request_key: str, start_column: str) -> DataFrame:
    """``id~~start~~n`` keyed ``<id>_count`` for requests that found children."""
    return counted.filter("child_count > 0").select(
        F.concat(F.col(request_key).cast("string"), F.lit("_count")).alias("key"),
        pack(F.col(request_key).cast("string"), F.col(start_column).cast("string"),
             F.col("child_count").cast("string")).alias("value"),
    )


def route_attempts(counted: DataFrame, attempt: str = "attempt", limit: int = MAX_ATTEMPT) -> DataFrame:
    """Adds ``route`` (done, retry, give_up) and ``next_attempt``.

    An empty lookup raises the attempt; it is queued again while the old
    attempt is at most ``limit`` and goes to the give-up output after that.
    """
    route = (
        F.when(F.col("child_count") > 0, "done")
        .when(F.col(attempt) <= limit, "retry")
        .otherwise("give_up")
    )
    return counted.withColumn("route", route).withColumn(
        "next_attempt", F.when(route == "done", F.col(attempt)).otherwise(F.col(attempt) + 1))


def failure_messages(
    routed: DataFrame, request_key: str, start_column: str, now: datetime | None = None,
) -> DataFrame:
    """``id~~start~~epochMs~~attempt`` keyed ``<id>_fail``, without repeats."""
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return (
        routed.filter("route = 'retry'")
        .select(
            F.concat(F.col(request_key).cast("string"), F.lit("_fail")).alias("key"),
            pack(
                F.col(request_key).cast("string"), F.col(start_column).cast("string"),
                F.unix_millis(stamp).cast("string"), F.col("next_attempt").cast("string"),
            ).alias("value"),
        )
        .dropDuplicates()
    )


def give_up_messages(routed: DataFrame, request_key: str, start_column: str) -> DataFrame:
    """``id~~start~~attempt`` keyed ``<id>_give_up`` for requests that are not tried again."""
    return routed.filter("route = 'give_up'").select(
        F.concat(F.col(request_key).cast("string"), F.lit("_give_up")).alias("key"),
        pack(F.col(request_key).cast("string"), F.col(start_column).cast("string"),
             F.col("next_attempt").cast("string")).alias("value"),
    ).dropDuplicates()


def unpack_failures(messages: DataFrame) -> DataFrame:
    """Failure messages -> typed request rows."""
    return messages.select(
        unpack("value", 0).alias("meeting_id"),
        unpack("value", 1).alias("start_time"),
        F.timestamp_millis(unpack("value", 2).try_cast("bigint")).alias("update_time"),
        F.coalesce(unpack("value", 3).try_cast("int"), F.lit(0)).alias("attempt"),
    )


def is_due(update_column: str = "update_time", now: datetime | None = None, delay: str = RETRY_DELAY) -> Column:
    """True when the last try is older than the delay; a missing time counts as not due."""
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return F.coalesce(F.col(update_column) < stamp - F.expr(delay), F.lit(False))


def split_due(requests: DataFrame, update_column: str = "update_time", now: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(due for another try, to be put back on the queue unchanged)."""
    due = is_due(update_column, now)
    return requests.filter(due), requests.filter(~due)


def enrich_with_fetcher(
    requests: DataFrame,
    request_key: str,
    fetch: Callable[[str], list[dict]],
    fields: Sequence[str] = CHILD_FIELDS,
    tries: int = 3,
) -> DataFrame:
    """Requests with a ``children`` array fetched on the executors.

    ``fetch`` returns the child records of one id.  A call that keeps failing
    is tried ``tries`` times and then leaves a null array, where a call that
    found nothing leaves an empty one; both take the failure route.
    """
    child_type = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    schema = T.StructType([*requests.schema.fields, T.StructField("children", child_type)])

    def lookup(identifier: str) -> list[dict] | None:
        for _ in range(tries):
            try:
                return [{f: r.get(f) for f in fields} for r in fetch(identifier)]
            except OSError:
                continue
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(children=[lookup(str(v)) for v in batch[request_key]])

    return requests.mapInPandas(run, schema)
