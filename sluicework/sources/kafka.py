"""Kafka reads: options, offsets, decoding, and replay from a message table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators import offsets
from sluicework.operators.codec import decode
from sluicework.plans.spec import first_of, flag
from sluicework.session import shared_dir
from sluicework.sources.core import SOURCES, STREAMS
from sluicework.sources.files import declared_schema


def security_options(properties: Mapping[str, str]) -> dict[str, str]:
    if not (flag(properties, "is_ssl_enabled") or flag(properties, "is_ssL_enabled")):
        return {}
    user, password = properties["user"], properties["password"]
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
    }


def batch_options(properties: Mapping[str, str], starting: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": properties["bootstrap_servers"],
        "subscribe": properties["topic"],
        "failOnDataLoss": "false",
        "startingOffsets": starting,
        "endingOffsets": "latest",
        **security_options(properties),
    }


def stream_options(properties: Mapping[str, str]) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": properties["bootstrap_servers"],
        "subscribe": properties["topic"],
        "failOnDataLoss": "false",
        "startingOffsets": first_of(properties, "startingOffsets", "starting_offsets", default="earliest"),
        **security_options(properties),
    }
    if "group_id" in properties:
        options["kafka.group.id"] = properties["group_id"]
    limit = first_of(properties, "offsets_per_trigger", "maxOffsetsPerTrigger")
    if limit:
        options["maxOffsetsPerTrigger"] = limit
    return options


def _avro_text(properties: Mapping[str, str]) -> str | None:
    if properties.get("data_format") != "avro":
        return None
    with open(f"{properties['schema_location']}/{properties['schema']}.avsc", encoding="utf-8") as handle:
        return handle.read()


def decoded(rows: DataFrame, properties: Mapping[str, str]) -> DataFrame:
    return decode(
        rows, properties.get("data_format", "json"), declared_schema(properties),
        properties.get("filter_value"), _avro_text(properties))


def topic_partitions(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """``topic, partition`` of a topic as the broker lists them; needs the Kafka package, like the read itself."""
    java = spark._jvm
    settings = java.java.util.Properties()
    settings.put("bootstrap.servers", properties["bootstrap_servers"])
    for name, value in security_options(properties).items():
        settings.put(name.removeprefix("kafka."), value)
    admin = java.org.apache.kafka.clients.admin.AdminClient.create(settings)
    try:
        topic = properties["topic"]
        told = admin.describeTopics(java.java.util.Collections.singletonList(topic)).allTopicNames().get().get(topic)
        return spark.createDataFrame([(topic, p.partition()) for p in told.partitions()], "topic string, partition int")
    finally:
        admin.close()


def raw_batch(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Rows after the committed offsets, from the broker or a message table."""
    commits, group = properties.get("commit_table"), properties.get("group_id", "")
    done = offsets.committed_offsets(spark, commits, group, properties["topic"]) if commits else None
    if "replay_path" in properties:
        rows = spark.read.parquet(properties["replay_path"]).filter(F.col("topic") == properties["topic"])
        return offsets.after_offsets(rows, done)
    if done is not None:
        done = offsets.start_offsets(topic_partitions(spark, properties), done)
    return spark.read.format("kafka").options(
        **batch_options(properties, offsets.starting_offsets_json(done))).load()


def staged_batch(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Raw rows written once to the shared folder.

    "Latest" moves while a run goes on; the copy fixes what every output of the
    run sees and what is committed after it.
    """
    path = shared_dir(spark, "kafka")
    raw_batch(spark, properties).write.parquet(path)
    return spark.read.parquet(path)


def commit_read(rows: DataFrame, properties: Mapping[str, str], batch_id: str) -> bool:
    """Commit the offsets of the staged rows of a finished run."""
    if "commit_table" not in properties:
        return False
    return offsets.commit_offsets(
        offsets.next_offsets(rows), properties["commit_table"], properties.get("group_id", ""), batch_id,
        properties.get("commit", "true"))


@SOURCES.register("kafka")
def read_kafka(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return decoded(raw_batch(spark, properties), properties)


@STREAMS.register("kafka")
def stream_kafka(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    if "replay_path" in properties:
        sample = spark.read.parquet(properties["replay_path"]).schema
        reader = spark.readStream.schema(sample)
        limit = properties.get("max_files_per_trigger")
        if limit:
            reader = reader.option("maxFilesPerTrigger", limit)
        rows = reader.parquet(properties["replay_path"])
        return decoded(rows.filter(F.col("topic") == properties["topic"]), properties)
    return decoded(spark.readStream.format("kafka").options(**stream_options(properties)).load(), properties)
