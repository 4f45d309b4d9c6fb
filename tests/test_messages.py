import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from sluicework.operators import codec, offsets
from sluicework.sinks import kafka as kafka_sink
from sluicework.sources import kafka as kafka_source

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture
def messages(spark):
    values = [("k_1", '{"a":1,"b":"x"}', 0, 0), ("kx1", '{"a":2}', 0, 1), (None, "broken", 1, 0), ("k%", '{"a":3,"b":"é"}', 1, 5)]
    df = spark.createDataFrame(values, "key string, value string, partition int, offset bigint")
    return df.select(F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("t").alias("topic"), "partition", "offset")


def test_decode_json_keeps_malformed_as_nulls(messages):
    assert rows(codec.decode(messages, "json", SCHEMA)) == sorted([(1, "x"), (2, None), (None, None), (3, "é")], key=repr)


def test_key_filter_is_literal(messages):
    assert rows(codec.decode(messages, "json", SCHEMA, "k_")) == [(1, "x")]
    assert rows(codec.decode(messages, "json", SCHEMA, "%")) == [(3, "é")]


def test_decode_errors(messages):
    with pytest.raises(ValueError, match="schema"):
        codec.decode(messages, "json")
    with pytest.raises(ValueError, match="unknown data_format"):
        codec.decode(messages, "other")


def test_encode_decode_is_identity(spark):
    df = spark.createDataFrame([(1, "a\"b\n"), (2, None), (None, "ü")], SCHEMA)
    back = codec.decode(codec.encode(df), "json", SCHEMA)
    assert rows(back) == rows(df)


def test_encode_text_uses_own_key(spark):
    df = spark.createDataFrame([("k", "v", 7)], "key string, value string, n int")
    assert rows(codec.encode(df, "text")) == [("k", "v")]
    assert rows(codec.encode(df, "text", ["n", "key"])) == [("7:k", "v")]


def test_connect_envelope(spark):
    df = spark.createDataFrame([(1, None)], "Id int, Name string")
    value = json.loads(codec.encode(df, "json_connect", ["id"], '{"type":"struct","fields":[]}').first()["value"])
    assert value["payload"] == {"id": 1}
    assert value["schema"]["type"] == "struct"


def test_offsets_resume_exactly(spark, messages, tmp_path):
    path = str(tmp_path / "commits")
    assert offsets.committed_offsets(spark, path, "g", "t") is None
    assert offsets.starting_offsets_json(None) == "earliest"
    first = messages.filter("partition = 0 AND offset = 0")
    assert offsets.commit_offsets(offsets.next_offsets(first), path, "g", "b1", "false") is False
    offsets.commit_offsets(offsets.next_offsets(first), path, "g", "b1")
    done = offsets.committed_offsets(spark, path, "g", "t")
    assert offsets.starting_offsets_json(done) == '{"t": {"0": 1}}'
    rest = offsets.after_offsets(messages, done)
    assert rows(rest, "partition", "offset") == [(0, 1), (1, 0), (1, 5)]
    assert offsets.committed_offsets(spark, path, "other", "t").isEmpty()


def test_zero_offset_is_earliest_marker(spark):
    df = spark.createDataFrame([("t", 0, 0), ("t", 1, 9)], "topic string, partition int, next_offset bigint")
    assert json.loads(offsets.starting_offsets_json(df)) == {"t": {"0": -2, "1": 9}}


SSL = {"bootstrap_servers": "h:9093", "topic": "t", "is_ssL_enabled": "true", "user": "u", "password": "p"}


def test_kafka_options():
    batch = kafka_source.batch_options(SSL, "earliest")
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest" and batch["failOnDataLoss"] == "false"
    assert batch["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in batch["kafka.sasl.jaas.config"]
    stream = kafka_source.stream_options({"bootstrap_servers": "h", "topic": "t", "offsets_per_trigger": "50", "group_id": "g"})
    assert stream["maxOffsetsPerTrigger"] == "50" and stream["startingOffsets"] == "earliest"
    assert "kafka.security.protocol" not in stream
    assert kafka_sink.writer_options(SSL)["topic"] == "t"
