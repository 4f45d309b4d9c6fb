"""Messages, records, runs and pages derived row by row from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import table
from sluicework.operators.skew import lookup_join, spread

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def kafka_events(spark: SparkSession, folder: str) -> DataFrame:
    """events as Kafka rows; one value in 97 is not JSON."""
    body = F.to_json(F.struct(
        "event_id", F.date_format("ts", MICROS).alias("ts"), "user_id", "event_type", "value", "props"))
    return spread(table(spark, folder, "events")).select(
        F.col("event_type").cast("binary").alias("key"),
        F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(body).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def meeting_messages(spark: SparkSession, folder: str) -> DataFrame:
    """events as meeting webhook messages."""
    key = F.col("event_id")
    kind = (
        F.when(key % 3 == 0, "meeting.started").when(key % 3 == 1, "meeting.ended")
        .when(key % 2 == 0, "meeting.participant_joined").otherwise("meeting.participant_left"))
    end = F.col("ts") + F.make_dt_interval(mins=(key % 90).cast("int"), secs=(key % 50).cast("int"))
    meeting = F.struct(
        F.when(key % 7 == 0, -1).when(key % 11 == 0, F.lit(None)).otherwise((key % 60).cast("int")).alias("duration"),
        F.date_format("ts", ISO).alias("start_time"),
        F.lit("UTC").alias("timezone"),
        F.when(key % 13 != 0, F.date_format(end, ISO)).alias("end_time"),
        F.col("event_type").alias("topic"),
        F.col("user_id").cast("string").alias("id"),
        F.lit(2).alias("type"),
        F.when(key % 17 != 0, F.concat(F.lit("m"), key.cast("string"))).alias("uuid"),
        F.concat(F.lit("h"), (key % 5).cast("string")).alias("host_id"),
        F.struct(F.concat(F.lit("p"), (key % 23).cast("string")).alias("user_id")).alias("participant"),
    )
    body = F.struct(
        kind.alias("event"), F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ts"),
        F.struct(F.lit("acct").alias("account_id"), meeting.alias("object")).alias("payload"))
    return spread(table(spark, folder, "events")).select("event_id", F.to_json(body).alias("value"))


MEETING_SCHEMA = """
  event STRING, event_ts BIGINT,
  payload STRUCT<account_id: STRING, object: STRUCT<duration: INT, start_time: STRING, timezone: STRING,
    end_time: STRING, topic: STRING, id: STRING, type: INT, uuid: STRING, host_id: STRING,
    participant: STRUCT<user_id: STRING>>>
"""


def orders_with_customer(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return lookup_join(spread(table(spark, folder, "orders")), customer, ["o_custkey"])


def activity_lines(spark: SparkSession, folder: str) -> DataFrame:
    """orders as nested activity records, one JSON line each.

    One line in 103 is not JSON and one record in 101 has no uid.  Arrays are
    built from the row itself, with at most three entries.
    """
    key = F.col("o_orderkey")
    text = key.cast("string")

    def first(most: int, make: Callable[[Column], Column]) -> Column:
        """``make(1)`` up to ``make(most)``, as many as the rest of the key by ``most + 1``; plain columns, no function per element."""
        n = F.greatest(F.lit(0), F.coalesce((key % (most + 1)).cast("int"), F.lit(0)))
        return F.slice(F.array(*[make(F.lit(i)) for i in range(1, most + 1)]), 1, n)

    participants = first(3, lambda i: F.struct(
        F.concat(F.lit("p"), text, F.lit("-"), i.cast("string")).alias("peopleai_id"),
        F.concat(F.lit("rep"), ((key + i) % 100).cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("Name "), i.cast("string")).alias("name"),
        F.when((key + i) % 2 == 0, "internal").otherwise("external").alias("type"),
        ((key * i) % 600).alias("time_spent"),
        F.struct(F.concat(F.lit("team"), (i % 2).cast("string")).alias("name")).alias("team"),
    ))
    campaigns = first(2, lambda i: F.struct(
        F.concat(F.lit("c"), ((key + i) % 9).cast("string")).alias("crm_id"),
        F.concat(F.lit("Campaign "), i.cast("string")).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"),
    ))
    account = F.struct(
        F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("crm_id"), F.col("c_name").alias("name"))
    lead = F.struct(
        F.concat(F.lit("l"), F.col("o_custkey").cast("string")).alias("crm_id"),
        F.concat(F.lit("lead"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"))
    opportunity = F.struct(
        F.concat(F.lit("o"), text).alias("crm_id"), F.col("c_mktsegment").alias("name"),
        F.col("o_orderpriority").alias("stage_name"), (key % 5).alias("stage_rank"))
    matched = F.element_at(
        F.array(F.lit("none"), F.lit("account"), F.lit("lead"), F.lit("opportunity")), (key % 4 + 1).cast("int"))
    record = F.struct(
        F.when(key % 101 != 0, F.concat(F.lit("u"), text)).alias("uid"),
        F.concat(F.lit("s"), text).alias("source_id"),
        F.element_at(F.array(F.lit("meeting"), F.lit("email"), F.lit("call")), (key % 3 + 1).cast("int")).alias("type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"),
        F.col("o_orderpriority").alias("subject"),
        F.date_format("o_orderdate", ISO).alias("timestamp"),
        first(3, lambda i: F.concat(F.lit("t"), i.cast("string"))).alias("tags"),
        F.when(key % 5 == 0, F.array(F.lit("f.txt"), F.lit("g.txt"))).alias("attachment_file_names"),
        (key % 2 == 0).alias("reply_received"),
        (key % 7200).alias("duration"),
        F.col("o_orderstatus").alias("status"),
        campaigns.alias("campaigns"),
        participants.alias("participants"),
        F.struct((key % 4).alias("total_participants"), (key % 2).alias("internal_participants")).alias("stats"),
        F.struct(
            (key % 2 == 1).alias("pushed"),
            F.concat(F.lit("task"), text).alias("crm_id"),
            matched.alias("matched_to"),
            F.when(key % 6 != 0, account).alias("account"),
            F.when(key % 4 == 2, lead).alias("lead"),
            F.when(key % 4 == 3, opportunity).alias("opportunity"),
        ).alias("crm_status"),
    )
    line = F.when(key % 103 == 0, F.lit("{broken")).otherwise(F.to_json(record))
    return orders_with_customer(spark, folder).select("o_orderkey", line.alias("value"))


def cost_pages(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as cost report pages: one page per month and supplier.

    The groups of a page are the three ship flags, so a page has at most three.
    """
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    flags = ("A", "N", "R")
    sums = (
        table(spark, folder, "lineitem")
        .groupBy(F.date_trunc("month", "l_shipdate").alias("month"), F.col("l_suppkey").alias("s_suppkey"))
        .agg(*[F.sum(F.when(F.col("l_returnflag") == f, price)).alias(f"sum_{f}") for f in flags])
    )
    named = sums.join(table(spark, folder, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
    account = F.concat(F.lit("acct"), F.col("s_suppkey").cast("string"))
    groups = F.array_compact(F.array(*[
        F.when(F.col(f"sum_{f}").isNotNull(), F.struct(
            F.array(account, F.lit(f"ship-{f}")).alias("Keys"),
            F.struct(F.struct(
                F.col(f"sum_{f}").cast("string").alias("Amount"), F.lit("USD").alias("Unit"),
            ).alias("AmortizedCost")).alias("Metrics")))
        for f in flags
    ]))
    period = F.struct(
        F.date_format("month", "yyyy-MM-dd").alias("Start"),
        F.date_format(F.add_months("month", 1), "yyyy-MM-dd").alias("End"))
    return named.select(
        F.array(F.struct(account.alias("Value"), F.struct(F.col("s_name").alias("description")).alias("Attributes")))
        .alias("DimensionValueAttributes"),
        F.array(F.struct(period.alias("TimePeriod"), groups.alias("Groups"))).alias("ResultsByTime"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """events as pipeline runs named after their type."""
    key = F.col("event_id")
    running = key % 5 == 0
    return table(spark, folder, "events").select(
        key.alias("id"), F.col("event_type").alias("name"), "user_id",
        F.when(running, "RUNNING").otherwise("FINISHED").alias("state"),
        F.when(running, "UNDEFINED").when(key % 5 == 1, "FAILED").otherwise("SUCCEEDED").alias("finalStatus"),
        F.col("ts").alias("startedTime"),
        F.col("ts").alias("launchTime"),
        F.when(~running, F.col("ts") + F.make_dt_interval(mins=(key % 50).cast("int"))).alias("finishedTime"),
        (key % 50 * 60000).alias("elapsedTime"),
    )


def schedule(spark: SparkSession) -> DataFrame:
    """The schedule is configuration: a fixed handful of pipeline names."""
    rows = [
        ("click", ["06:00", "18:30"], ["timeout"]),
        ("purchase", ["00:00"], []),
        ("signup", ["12:15"], None),
        ("nightly", ["23:30"], ["timeout", "refused"]),
    ]
    return spark.createDataFrame(rows, "name STRING, scheduledAt ARRAY<STRING>, errorLogPatterns ARRAY<STRING>")


def part_xml(spark: SparkSession, folder: str) -> DataFrame:
    """part as namespaced XML pages of two records; one second record in nine is empty."""
    def record(identifier, name, price):
        return F.concat(
            F.lit('<pc:record kind="part"><pc:id>'), identifier, F.lit("</pc:id><pc:name>"), name,
            F.lit("</pc:name><pc:price>"), price, F.lit("</pc:price></pc:record>"))

    key = F.col("p_partkey")
    price = F.format_number(F.col("p_retailprice").cast("bigint"), 0)
    second = F.when(key % 9 == 0, F.lit("<pc:record/>")).otherwise(
        record((-key - 1).cast("string"), F.col("p_brand"), F.lit("")))
    return spread(table(spark, folder, "part")).select("p_partkey", F.concat(
        F.lit('<pc:page xmlns:pc="urn:core">'), record(key.cast("string"), F.col("p_name"), price), second,
        F.lit("</pc:page>")).alias("xml"))


def log_pages(spark: SparkSession, folder: str) -> DataFrame:
    """pages wrapped as escaped log pages of fifty applications, three attempts each."""
    escaped = F.replace(F.replace("html", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return table(spark, folder, "pages").select(
        (F.col("page_id") % 50).alias("id"),
        (F.expr("page_id div 50") % 3).alias("attempt_id"),
        F.concat(F.lit('<html><table id="layout"><tbody><tr><td>menu</td><td><pre>'), escaped,
                 F.lit("</pre></td></tr></tbody></table></html>")).alias("html"),
    )
