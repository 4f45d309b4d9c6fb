"""Kafka-shaped rows: value decoding, encoding and key filters."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators.columns import lower_case_columns

# Fixed value: the row shape Spark's Kafka source produces.
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

KEY_SEPARATOR = ":"


def filter_by_key(df: DataFrame, text: str | None) -> DataFrame:
    """Keep rows whose key contains ``text`` literally (``%``, ``_`` are plain)."""
    return df.filter(F.col("key").cast("string").contains(text)) if text else df


def expand_once(df: DataFrame, record: Column, keep: Sequence[str] = ()) -> DataFrame:
    """A struct expression -> its fields as columns, evaluated once per row.

    Filters on the fields stay above the expansion.  After a plain
    ``select("r.*")`` they would be pushed below it together with the
    expression, and costly parsing would run again for each of them.
    """
    return df.select(*keep, F.inline(F.array(record)))


def decode_json(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Value text -> flat typed columns; malformed text gives an all-null row."""
    return expand_once(df, F.from_json(F.col("value").cast("string"), schema))


def decode_text(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"))


def decode_avro(df: DataFrame, avro_schema: str) -> DataFrame:
    """Needs the spark-avro package on the cluster."""
    from pyspark.sql.avro.functions import from_avro

    return df.select(from_avro(F.col("value"), avro_schema).alias("data")).select("data.*")


def decode(
    df: DataFrame,
    data_format: str,
    schema: T.StructType | str | None = None,
    filter_value: str | None = None,
    avro_schema: str | None = None,
) -> DataFrame:
    kept = filter_by_key(df, filter_value)
    if data_format == "json":
        if schema is None:
            raise ValueError("json values need a schema")
        return decode_json(kept, schema)
    if data_format == "text":
        return decode_text(kept)
    if data_format == "avro":
        if avro_schema is None:
            raise ValueError("avro values need an Avro schema")
        return decode_avro(kept, avro_schema)
    raise ValueError(f"unknown data_format '{data_format}'")


def _row_struct(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def message_key(columns: Sequence[str]) -> Column:
    """Key columns joined by ``:``; nulls are skipped."""
    return F.concat_ws(KEY_SEPARATOR, *[F.col(name) for name in columns]).alias("key")


def connect_schema_literal(df: DataFrame, schema_json: str) -> Column:
    """The schema document as a literal struct, same for every row."""
    schema = F.schema_of_json(F.lit(json.dumps(json.loads(schema_json))))
    return F.from_json(F.lit(schema_json), schema)


def encode(
    df: DataFrame,
    data_format: str = "json",
    key_columns: Sequence[str] = (),
    connect_schema: str | None = None,
) -> DataFrame:
    """Rows -> ``key``/``value`` messages (``value`` only when there is no key)."""
    if data_format == "json":
        value = F.to_json(_row_struct(df))
    elif data_format == "text":
        keyed = message_key(key_columns) if key_columns else F.col("key")
        return df.select(keyed, F.col("value"))
    elif data_format == "avro":
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(_row_struct(df))
    elif data_format == "json_connect":
        if connect_schema is None:
            raise ValueError("json_connect needs a schema document")
        df = lower_case_columns(df)
        envelope = F.struct(
            connect_schema_literal(df, connect_schema).alias("schema"),
            _row_struct(df).alias("payload"),
        )
        value = F.to_json(envelope)
    else:
        raise ValueError(f"unknown data_format '{data_format}'")
    keys = [message_key(key_columns)] if key_columns else []
    return df.select(*keys, value.alias("value"))
