"""Cost report pages and account lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = """
  DimensionValueAttributes ARRAY<STRUCT<Value: STRING, Attributes: STRUCT<description: STRING>>>,
  ResultsByTime ARRAY<STRUCT<
    TimePeriod: STRUCT<Start: STRING, End: STRING>,
    Groups: ARRAY<STRUCT<Keys: ARRAY<STRING>,
      Metrics: STRUCT<AmortizedCost: STRUCT<Amount: STRING, Unit: STRING>>>>>>
"""


def flatten_costs(pages: DataFrame) -> DataFrame:
    """Time bucket x group -> one cost row, described from its own page.

    The description sits in the page that holds the group, so it is picked from
    the page's array and needs no join; of repeated entries the last one counts.
    """
    described = F.filter(
        "DimensionValueAttributes", lambda d: d["Value"].isNotNull() & d["Attributes"].isNotNull())
    buckets = pages.select(described.alias("described"), F.explode("ResultsByTime").alias("b"))
    groups = buckets.select("described", F.col("b.TimePeriod").alias("period"), F.explode("b.Groups").alias("g"))
    account = F.get(F.col("g.Keys"), F.lit(0))
    hit = F.filter("described", lambda d: d["Value"] == account)
    return groups.select(
        F.to_date("period.Start").alias("startDate"),
        F.to_date("period.End").alias("endDate"),
        account.alias("account"),
        F.get(F.col("g.Keys"), F.lit(1)).alias("service"),
        F.try_element_at(hit, F.lit(-1))["Attributes"]["description"].alias("description"),
        F.col("g.Metrics.AmortizedCost.Amount").cast("double").alias("amount"),
        F.col("g.Metrics.AmortizedCost.Unit").alias("currency"),
    )


def with_cost_id(costs: DataFrame) -> DataFrame:
    return costs.withColumn("id", F.concat(F.col("startDate").cast("string"), "account", "service"))


def account_list(pages: DataFrame) -> DataFrame:
    """Account pages -> rows, joined time as UTC text."""
    accounts = pages.select(F.explode("Accounts").alias("a")).select("a.*")
    return accounts.withColumn(
        "JoinedTimestamp", F.date_format(F.to_timestamp("JoinedTimestamp"), "yyyy-MM-dd HH:mm:ss"))
