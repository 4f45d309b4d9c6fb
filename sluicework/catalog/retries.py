"""Enrichment with children, counts and failures; attempts and delayed retry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, table
from sluicework.operators import enrich, meeting

CATALOG = Catalog()

NOW = datetime(2024, 1, 15, 12, 0, 0)
NOW_MS = 1705320000000

COUNTED = """(SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS start_time, CAST(o_orderkey % 6 AS INTEGER) AS attempt,
  coalesce(n, 0) AS n FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey)"""


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("meeting_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_time"),
        (F.col("o_orderkey") % 6).cast("int").alias("attempt"))


def lookup(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").filter("l_returnflag = 'R'")


def counted(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.child_counts(requests(spark, folder), lookup(spark, folder), "meeting_id", "l_orderkey")


@CATALOG.query("enrich_children", """
  SELECT CAST(o_orderkey AS VARCHAR) AS "meetingId", CAST(l_linenumber AS VARCHAR) AS id,
         CASE WHEN l_partkey % 10 = 0 THEN '' ELSE 'd' || l_partkey END AS device, '' AS location
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'
""")
def enrich_children(spark: SparkSession, folder: str) -> DataFrame:
    """Found children, missing fields as empty text."""
    found = enrich.children_of(requests(spark, folder), lookup(spark, folder), "meeting_id", "l_orderkey")
    children = found.select("meeting_id", F.array(F.struct(
        F.col("l_linenumber").alias("id"),
        F.when(F.col("l_partkey") % 10 != 0, F.concat(F.lit("d"), F.col("l_partkey").cast("string"))).alias("device"),
    )).alias("children"))
    return enrich.flatten_children(children, "children", "meeting_id").select("meetingId", "id", "device", "location")


@CATALOG.query("enrich_counts", f"""
  SELECT o_orderkey || '_count' AS key, o_orderkey || '~~' || start_time || '~~' || n AS value FROM {COUNTED} WHERE n > 0
""")
def enrich_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Packed count message per request."""
    return enrich.count_messages(counted(spark, folder), "meeting_id", "start_time")


@CATALOG.query("enrich_failed", f"""
  SELECT o_orderkey || '_fail' AS key, o_orderkey || '~~' || start_time || '~~{NOW_MS}~~' || (attempt + 1) AS value
  FROM {COUNTED} WHERE n = 0 AND attempt <= 3
""")
def enrich_failed(spark: SparkSession, folder: str) -> DataFrame:
    """Packed failure message per request to try again."""
    return enrich.failure_messages(enrich.route_attempts(counted(spark, folder)), "meeting_id", "start_time", NOW)


@CATALOG.query("retry_route", f"""
  SELECT CASE WHEN n > 0 THEN 'done' WHEN attempt <= 3 THEN 'retry' ELSE 'give_up' END AS route,
         CAST(CASE WHEN n > 0 THEN attempt ELSE attempt + 1 END AS INTEGER) AS next_attempt, CAST(count(*) AS BIGINT) AS requests
  FROM {COUNTED} GROUP BY 1, 2
""")
def retry_route(spark: SparkSession, folder: str) -> DataFrame:
    """Done, another try, or given up."""
    return enrich.route_attempts(counted(spark, folder)).groupBy("route", "next_attempt").agg(
        F.count(F.lit(1)).alias("requests"))


def failure_queue(spark: SparkSession, folder: str) -> DataFrame:
    """events as packed failure messages stamped with their own time."""
    key = F.col("event_id")
    return table(spark, folder, "events").select(
        F.concat(key.cast("string"), F.lit("_fail")).alias("key"),
        F.concat_ws("~~", key.cast("string"), F.date_format("ts", "yyyy-MM-dd"),
                    F.when(key % 19 == 0, "not-a-number").otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string")),
                    F.when(key % 23 != 0, (key % 4).cast("string"))).alias("value"))


@CATALOG.query("retry_due", """
  SELECT event_id % 19 <> 0 AND epoch_ms(ts) < epoch_ms(TIMESTAMP '2024-01-15 11:58:00') AS due,
         CAST(CASE WHEN event_id % 23 = 0 THEN 0 ELSE event_id % 4 END AS INTEGER) AS attempt,
         CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2
""")
def retry_due(spark: SparkSession, folder: str) -> DataFrame:
    """Due after two minutes, otherwise back on the queue."""
    due, waiting = enrich.split_due(enrich.unpack_failures(failure_queue(spark, folder)), now=NOW)
    both = due.withColumn("due", F.lit(True)).unionByName(waiting.withColumn("due", F.lit(False)))
    return both.groupBy("due", "attempt").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query("count_label", """
  SELECT CAST(l_suppkey AS VARCHAR) || '-' || CAST(p AS VARCHAR) AS "meetingId", 's' AS "startTime",
         CAST(l_suppkey AS VARCHAR) || '-' || CAST(p AS VARCHAR) || '~~s' AS id,
         CASE WHEN n BETWEEN 1 AND 10 THEN n || ' Participant' WHEN n BETWEEN 11 AND 20 THEN '11-20 Participant'
              WHEN n BETWEEN 21 AND 50 THEN '20-50 Participant' ELSE '50+ Participant' END AS "participantBucket"
  FROM (SELECT l_suppkey, l_partkey % 37 AS p, count(*) - 5 AS n FROM lineitem GROUP BY 1, 2)
""")
def count_label(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of packed messages to range labels."""
    counts = table(spark, folder, "lineitem").groupBy("l_suppkey", (F.col("l_partkey") % 37).alias("p")).agg(
        (F.count(F.lit(1)) - 5).alias("n"))
    packed = counts.select(F.concat_ws(
        "~~", F.concat_ws("-", F.col("l_suppkey").cast("string"), F.col("p").cast("string")), F.lit("s"),
        F.col("n").cast("string")).alias("value"))
    return meeting.count_facts(packed)
