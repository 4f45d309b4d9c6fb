"""JDBC scans, and option maps for stores whose connector comes with the cluster."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sluicework.plans.spec import flag
from sluicework.sources.core import SOURCES

SNOWFLAKE_DRIVER = "net.snowflake.client.jdbc.SnowflakeDriver"
MONGO_SAMPLE = "500000"


def jdbc_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Connection plus either the pushed query or a partitioned table read.

    ``query`` cannot be partitioned by Spark, so with ``partition_column`` the
    query becomes a derived table and is read in ``num_partitions`` ranges.
    """
    options = {k: properties[k] for k in ("url", "driver", "user", "password", "fetchsize") if properties.get(k)}
    if "partition_column" in properties:
        options.update({
            "dbtable": f"({properties['query']}) src",
            "partitionColumn": properties["partition_column"],
            "lowerBound": properties["lower_bound"],
            "upperBound": properties["upper_bound"],
            "numPartitions": properties["num_partitions"],
        })
    else:
        options["query"] = properties["query"]
    return options


@SOURCES.register("rdb", "jdbc")
def read_jdbc(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(properties)).load()


def read_jdbc_ranges(spark: SparkSession, properties: Mapping[str, str], table: str, predicates: list[str]) -> DataFrame:
    """One task per range predicate."""
    connection = {k: properties[k] for k in ("driver", "user", "password", "fetchsize") if properties.get(k)}
    return spark.read.jdbc(properties["url"], table, predicates=predicates, properties=connection)


def snowflake_options(properties: Mapping[str, str]) -> dict[str, str]:
    return {
        "url": properties["url"],
        "driver": SNOWFLAKE_DRIVER,
        "user": properties["user"],
        "password": properties["password"],
        "warehouse": properties["warehouse"],
        "db": properties["db_name"],
        "schema": properties["schema"],
        "query": properties["query"],
    }


@SOURCES.register("snowflake")
def read_snowflake(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**snowflake_options(properties)).load()


def elastic_options(properties: Mapping[str, str]) -> dict[str, str]:
    options = {
        "es.read.metadata": str(flag(properties, "metadata")).lower(),
        "es.nodes.wan.only": "true",
        "es.port": properties["port"],
        "es.net.ssl": str(flag(properties, "ssl")).lower(),
        "es.nodes": properties["nodes"],
        "pushdown": "true",
    }
    if "query" in properties:
        options["es.query"] = properties["query"]
    if "user" in properties and "password" in properties:
        options["es.net.http.auth.user"] = properties["user"]
        options["es.net.http.auth.pass"] = properties["password"]
    return options


@SOURCES.register("elastic")
def read_elastic(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("org.elasticsearch.spark.sql").options(
        **elastic_options(properties)).load(properties["index"])


def mongo_uri(uri: str, database: str, collection: str) -> str:
    return f"{uri}/{database}.{collection}"


def mongo_options(properties: Mapping[str, str]) -> dict[str, str]:
    options = {
        "connection.uri": properties["uri"],
        "database": properties["db_name"],
        "collection": properties["collection_name"],
        "sampleSize": MONGO_SAMPLE,
    }
    if properties.get("pipeline"):
        options["aggregation.pipeline"] = properties["pipeline"]
    return options


@SOURCES.register("mongo")
def read_mongo(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("mongodb").options(**mongo_options(properties)).load()


def redis_options(properties: Mapping[str, str]) -> dict[str, str]:
    options = {name: properties[name] for name in ("host", "port", "auth", "timeout", "table")}
    options["key.column"] = properties["key_column"]
    return options


@SOURCES.register("redis")
def read_redis(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("org.apache.spark.sql.redis").options(**redis_options(properties)).load()


def bigquery_options(properties: Mapping[str, str]) -> dict[str, str]:
    return {
        "credentialsFile": properties["credential_file"],
        "viewsEnabled": "true",
        "parentProject": properties["project_id"],
        "materializationProject": properties["project_id"],
        "materializationDataset": properties["data_set"],
        "query": properties["query"],
    }


@SOURCES.register("bigquery")
def read_bigquery(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.format("bigquery").options(**bigquery_options(properties)).load()
