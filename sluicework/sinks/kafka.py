"""Kafka sink: message encoding plus writer options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators.codec import encode
from sluicework.plans.spec import column_list, save_mode
from sluicework.sinks.core import SINKS
from sluicework.sources.kafka import security_options


def writer_options(properties: Mapping[str, str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": properties["bootstrap_servers"],
        "topic": properties["topic"],
        **security_options(properties),
    }


def messages(df: DataFrame, properties: Mapping[str, str]) -> DataFrame:
    connect = None
    if properties.get("data_format") == "json_connect":
        path = f"{properties['kafka_connect_schema_path']}/{properties['kafka_connect_schema']}.json"
        with open(path, encoding="utf-8") as handle:
            connect = handle.read()
    return encode(
        df, properties.get("data_format", "json"), column_list(properties.get("kafka_partition_cols")), connect)


@SINKS.register("kafka", "WriteToKafka")
def write_kafka(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """Write messages to a topic, or to ``replay_path`` as a message table.

    The message table has one folder per topic, batch and output, so a replayed
    batch replaces its own messages and no others.
    """
    encoded = messages(df, properties)
    replay = properties.get("replay_path")
    if replay:
        encoded.withColumn("published_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{replay.rstrip('/')}/topic={properties['topic']}/batch_id={batch_id}/output={properties.get('output_index', '0')}")
        return
    encoded.write.format("kafka").mode(save_mode(properties)).options(**writer_options(properties)).save()
