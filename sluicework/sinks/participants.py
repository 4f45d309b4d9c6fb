"""Sink that enriches lookup requests and publishes the results: children, counts, failures, give-ups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators import enrich
from sluicework.plans.hooks import resolve_hook
from sluicework.plans.spec import flag
from sluicework.session import delete_path, shared_dir
from sluicework.sinks.core import SINKS
from sluicework.sinks.files import write_console
from sluicework.sinks.kafka import write_kafka

FAIL_SUFFIX = "_fail"
GIVE_UP_SUFFIX = "_give_up"


def enriched_results(requests: DataFrame, properties: Mapping[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages for the topic, for its fail topic, for its give-up topic).

    The children come from ``lookup_path`` (a table with the parent id in
    ``lookup_key``) or from a fetch function named by ``fetcher``.  A fetch
    is written to the shared folder first, so that each id is asked for once
    although three results read it.
    """
    key = properties.get("request_key", "meeting_id")
    start = properties.get("start_column", "start_time")
    if "attempt" not in requests.columns:
        requests = requests.withColumn("attempt", F.lit(0))
    if "lookup_path" in properties:
        lookup_key = properties.get("lookup_key", "meetingId")
        lookup = requests.sparkSession.read.parquet(properties["lookup_path"])
        # Only what the batch asks for is counted and sent on.
        found = lookup.join(requests.select(F.col(key).alias(lookup_key)).distinct(), lookup_key, "left_semi")
        counted = enrich.child_counts(requests, found, key, lookup_key)
        packed = found.select(F.col(lookup_key).alias(key), F.array(F.struct("*")).alias("children"))
    else:
        fetch = resolve_hook(properties["fetcher"])
        spark = requests.sparkSession
        path = properties["_stage_path"]
        enrich.enrich_with_fetcher(requests, key, fetch).write.mode("overwrite").parquet(path)
        packed = spark.read.parquet(path)
        counted = packed.withColumn("child_count", F.coalesce(F.size("children"), F.lit(0)).cast("long")).drop("children")
    children = enrich.flatten_children(packed, "children", key)
    routed = enrich.route_attempts(counted)
    topic = enrich.child_messages(children).unionByName(enrich.count_messages(counted, key, start))
    return topic, enrich.failure_messages(routed, key, start), enrich.give_up_messages(routed, key, start)


@SINKS.register("participants", "WriteZoomParticipantDevice")
def write_participants(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    staged = shared_dir(df.sparkSession, "fetched")
    topic, failed, given_up = enriched_results(df, {**properties, "_stage_path": staged})
    writer = write_console if flag(properties, "test") else write_kafka
    plain = {k: v for k, v in properties.items() if k != "kafka_partition_cols"}
    writer(topic, batch_id, {**plain, "data_format": "text"})
    writer(failed, batch_id, {**plain, "data_format": "text", "topic": properties["topic"] + FAIL_SUFFIX})
    writer(given_up, batch_id, {**plain, "data_format": "text", "topic": properties["topic"] + GIVE_UP_SUFFIX})
    delete_path(df.sparkSession, staged)
