"""Option maps for stores whose connector comes with the cluster."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from sluicework.plans.spec import flag, save_mode
from sluicework.sinks.core import SINKS, with_retry


def elastic_options(properties: Mapping[str, str]) -> dict[str, str]:
    options = {
        "es.index.auto.create": "true",
        "es.port": properties["port"],
        "es.nodes": properties["nodes"],
        "es.net.ssl": str(flag(properties, "ssl")).lower(),
        "es.nodes.data.only": str(flag(properties, "data_only")).lower(),
        "es.resource": elastic_resource(properties),
    }
    if flag(properties, "wan_only"):
        options["es.nodes.wan.only"] = "true"
    if properties.get("upsert", "").lower() == "upsert":
        options["es.write.operation"] = "upsert"
    optional = {
        "mapping_id": "es.mapping.id",
        "pipeline": "es.ingest.pipeline",
        "retryOnConflict": "es.update.retry.on.conflict",
        "user": "es.net.http.auth.user",
        "password": "es.net.http.auth.pass",
        "retryCount": "es.batch.write.retry.count",
        "retryWaitTime": "es.batch.write.retry.wait",
    }
    options.update({option: properties[key] for key, option in optional.items() if key in properties})
    return options


def elastic_resource(properties: Mapping[str, str]) -> str:
    """Plain index, or the connector's own time pattern when both parts are set."""
    if "ts_col" in properties and "ts_format" in properties:
        pattern = properties["ts_format"].replace("YYYY", "yyyy")
        return f"{properties['index']}-{{{properties['ts_col']}|{pattern}}}"
    return properties["index"]


@SINKS.register("elastic", "WriteToElastic")
def write_elastic(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    with_retry(
        lambda: df.write.format("org.elasticsearch.spark.sql")
        .options(**elastic_options(properties)).mode(save_mode(properties)).save())


def redis_options(properties: Mapping[str, str]) -> dict[str, str]:
    options = {name: properties[name] for name in ("host", "port", "auth", "table")}
    options["key.column"] = properties["key_column"]
    return options


@SINKS.register("redis", "WriteToRedis")
def write_redis(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    df.write.format("org.apache.spark.sql.redis").options(**redis_options(properties)).mode(
        save_mode(properties)).save()


def mongo_options(properties: Mapping[str, str]) -> dict[str, str]:
    return {
        "connection.uri": properties["uri"],
        "database": properties["db_name"],
        "collection": properties["collection_name"],
    }


@SINKS.register("mongo", "WriteToMongo")
def write_mongo(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    df.write.format("mongodb").options(**mongo_options(properties)).mode(save_mode(properties)).save()


def salesforce_options(properties: Mapping[str, str]) -> dict[str, str]:
    return {
        "login": properties["url"],
        "username": properties["user"],
        "password": properties["password"] + properties["security_token"],
        "sfObject": properties["table_name"],
        "version": properties.get("version", "52.0"),
    }


@SINKS.register("salesforce", "WriteToSalesForce")
def write_salesforce(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    df.write.format("com.springml.spark.salesforce").options(**salesforce_options(properties)).mode(
        save_mode(properties)).save()
