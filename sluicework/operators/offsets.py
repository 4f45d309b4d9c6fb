"""Offset bookkeeping for Kafka-shaped reads.

What is committed is what the batch read: the next offset per partition comes
from the rows themselves, never from the end of the topic at commit time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators.skew import lookup_join

EARLIEST = "earliest"
EARLIEST_OFFSET = -2


def next_offsets(rows: DataFrame) -> DataFrame:
    """``topic, partition, next_offset``: one past the last offset read."""
    return rows.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def with_start_marker(offsets: DataFrame) -> DataFrame:
    """Offset 0 is written as the marker for the earliest offset."""
    marked = F.when(F.col("next_offset") == 0, F.lit(EARLIEST_OFFSET)).otherwise(F.col("next_offset"))
    return offsets.withColumn("next_offset", marked.cast("long"))


def start_offsets(partitions: DataFrame, offsets: DataFrame | None) -> DataFrame:
    """Where a read of all ``partitions`` (topic, partition) starts: after what is committed, else at the earliest.

    A batch read must name every partition, also those that are new or had no
    rows when offsets were committed.
    """
    earliest = F.lit(EARLIEST_OFFSET).cast("long")
    if offsets is None:
        return partitions.select("topic", "partition", earliest.alias("next_offset"))
    return partitions.select("topic", "partition").distinct().join(offsets, ["topic", "partition"], "left").withColumn(
        "next_offset", F.coalesce("next_offset", earliest))


def starting_offsets_json(offsets: DataFrame | None) -> str:
    """Committed offsets -> the ``startingOffsets`` option text.

    One row per topic partition, a number the broker bounds, so this is one of
    the few places where rows come to the driver.
    """
    if offsets is None:
        return EARLIEST
    result: dict[str, dict[str, int]] = {}
    for row in with_start_marker(offsets).toLocalIterator():
        result.setdefault(row["topic"], {})[str(row["partition"])] = row["next_offset"]
    return json.dumps(result, sort_keys=True) if result else EARLIEST


def commit_offsets(offsets: DataFrame, table_path: str, group_id: str, batch_id: str, commit: str = "true") -> bool:
    """Append to the commit table, only when ``commit`` is exactly ``"true"``."""
    if commit != "true":
        return False
    rows = offsets.select(
        F.lit(group_id).alias("group_id"), "topic", "partition", "next_offset",
        F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("committed_at"),
    )
    rows.coalesce(1).write.mode("append").parquet(table_path)
    return True


def committed_offsets(spark: SparkSession, table_path: str, group_id: str, topic: str) -> DataFrame | None:
    """Highest committed offset per partition, or None before the first commit."""
    from sluicework.session import path_exists

    if not path_exists(spark, table_path):
        return None
    return (
        spark.read.parquet(table_path)
        .filter((F.col("group_id") == group_id) & (F.col("topic") == topic))
        .groupBy("topic", "partition")
        .agg(F.max("next_offset").alias("next_offset"))
    )


def after_offsets(rows: DataFrame, offsets: DataFrame | None) -> DataFrame:
    """Rows at or past the committed offset; partitions not committed pass whole."""
    if offsets is None:
        return rows
    return (
        lookup_join(rows, offsets, ["topic", "partition"], "left")
        .filter(F.col("offset") >= F.coalesce(F.col("next_offset"), F.lit(0)))
        .drop("next_offset")
    )
