"""File and object-store scans, batch and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.avro_schema import struct_from_avsc
from sluicework.operators.skew import spread
from sluicework.plans.spec import first_of, flag
from sluicework.sources.core import SOURCES, STREAMS

DEFAULT_FORMAT = "orc"
DEFAULT_PATH = "input"


def declared_schema(properties: Mapping[str, str]) -> T.StructType | None:
    """Schema from ``schema`` + ``schema_location``, or DDL text in ``schema_ddl``."""
    if "schema_ddl" in properties:
        return T.StructType.fromDDL(properties["schema_ddl"])
    if "schema" in properties and "schema_location" in properties:
        return struct_from_avsc(properties["schema_location"], properties["schema"])
    return None


def csv_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Delimiter, header and inference; inference only without a schema."""
    given = "schema" in properties or "schema_location" in properties
    infer = flag(properties, "inferSchema") and not given
    return {
        "delimiter": properties.get("delimiter", ","),
        "header": str(flag(properties, "header")).lower(),
        "inferSchema": str(infer).lower(),
    }


def file_format(properties: Mapping[str, str]) -> str:
    return properties.get("file_format", DEFAULT_FORMAT)


@SOURCES.register("file")
def read_files(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    kind = file_format(properties)
    reader = spark.read.format(kind)
    if "access_key" in properties or "endpoint" in properties:
        reader = reader.options(**s3_options(properties))
    if kind == "csv":
        reader = reader.options(**csv_options(properties))
    schema = declared_schema(properties)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(properties.get("path", DEFAULT_PATH))
    return spread(df, int(properties["input_partitions"])) if "input_partitions" in properties else df


@STREAMS.register("file")
def stream_files(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """File stream; the schema is declared, or read from ``sample_path``."""
    kind = file_format(properties)
    schema = declared_schema(properties)
    if schema is None:
        schema = spark.read.format(kind).load(properties["sample_path"]).schema
    reader = spark.readStream.format(kind).schema(schema)
    if kind == "csv":
        reader = reader.options(**csv_options(properties))
    limit = first_of(properties, "max_files_per_trigger", "maxFilesPerTrigger")
    if limit:
        reader = reader.option("maxFilesPerTrigger", limit)
    if "path_glob" in properties:
        reader = reader.option("pathGlobFilter", properties["path_glob"])
    df = reader.load(properties.get("path", DEFAULT_PATH))
    return with_file_columns(df) if flag(properties, "file_columns") else df


def with_file_columns(df: DataFrame) -> DataFrame:
    """Scanned rows with ``file_name`` and the start of their split; a frame that is no stream also gets an order in it.

    A stream's rows get that order in their micro-batch: see ``ledger.numbered_lines``.
    """
    named = df.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("_row_start"))
    return named if df.isStreaming else named.withColumn("_nth", F.monotonically_increasing_id())


def s3_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Per-read credentials; nothing is set on the session."""
    options = {"fs.s3a.endpoint": properties.get("endpoint", "s3.amazonaws.com")}
    if "access_key" in properties:
        options["fs.s3a.access.key"] = properties["access_key"]
        options["fs.s3a.secret.key"] = properties["secret_key"]
        options["fs.s3a.aws.credentials.provider"] = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
    return options


@SOURCES.register("s3")
def read_s3(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    schema = declared_schema(properties)
    reader = spark.read.options(**s3_options(properties))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(properties["bucket"])
