"""Console, file, staged, keyed and time-routed file sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.operators import ledger, snapshots
from sluicework.operators.skew import balanced
from sluicework.operators.upsert import route_by_time
from sluicework.plans.spec import column_list, first_of, flag, save_mode
from sluicework.session import delete_path, path_exists
from sluicework.sinks.core import SINKS


@SINKS.register("console", "WriteToConsole")
def write_console(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    df.printSchema()
    df.show(50, False)


@SINKS.register("file", "WriteToFile")
def write_file(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """``format, output_location, mode``, optional ``partition_cols``.

    ``idempotent=true`` writes each batch to its own ``batch_id=N`` folder, so
    a replayed micro-batch replaces itself rather than being added twice.
    """
    location, mode = properties["output_location"], save_mode(properties)
    if flag(properties, "idempotent"):
        location, mode = f"{location.rstrip('/')}/batch_id={batch_id}", "overwrite"
    columns = column_list(properties.get("partition_cols"))
    writer = balanced(df, *columns).write.partitionBy(*columns) if columns else df.write
    file_format = first_of(properties, "file_format", "format", default="parquet")
    writer.format(file_format).mode(mode).option("partitionOverwriteMode", "static").save(location)


@SINKS.register("keyed_file", "WriteKeyedFile")
def write_keyed_file(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """Insert or replace by ``mapping_id`` / ``key_cols`` in a keyed table, one delta per batch.

    A micro-batch is known by its query and number, so its replay adds nothing.  After every ``compact_after``
    deltas (20 by default, 0 for never) they are merged into the base.
    """
    target, keys = properties["output_location"], column_list(first_of(properties, "key_cols", "mapping_id"))
    number, _, query = str(batch_id).partition("-")
    known = (query, int(number)) if query and number.isdigit() else (None, None)
    snapshots.upsert(df, target, keys, properties.get("order_by"), int(properties.get("buckets", "64")), *known)
    limit = int(properties.get("compact_after", "20"))
    told = snapshots.manifest(df.sparkSession, target)
    if limit and told and len(told["deltas"]) >= limit:
        snapshots.compact(df.sparkSession, target)


@SINKS.register("routed_file", "WriteRoutedFile")
def write_routed_file(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """One folder per target name ``index-<time>``."""
    routed = route_by_time(df, properties["index"], properties.get("ts_col"), properties.get("ts_format"))
    balanced(routed, "target_index").write.partitionBy("target_index").mode(save_mode(properties)).parquet(
        properties["output_location"])


@SINKS.register("reload_file", "WriteReloadFile")
def write_reload_file(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """Replace the last ``last_n_days`` days of a day table in one commit."""
    snapshots.reload_days(
        df, properties["output_location"], properties.get("ts_col", "systemmodstamp"), int(properties["last_n_days"]))


def stage(df: DataFrame, location: str, file_format: str = "parquet", fresh: bool = False) -> None:
    """Append to a staging folder, emptied first when ``fresh``."""
    spark = df.sparkSession
    if fresh and path_exists(spark, location):
        delete_path(spark, location)
    df.write.mode("append").format(file_format).save(location)


def stage_by_bucket(df: DataFrame, location: str, table: str, bucket_column: str = "bucket") -> None:
    """Overwrite just the buckets the frame holds, at ``location/table/bucket=N``."""
    balanced(df, bucket_column).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(bucket_column).parquet(f"{location}/{table}")


@SINKS.register("staged", "WriteStaged")
def write_staged(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    stage(df, properties["output_location"], properties.get("file_format", "parquet"),
          flag(properties, "delete_first"))


@SINKS.register("ingest_files", "WriteIngestedFiles")
def write_ingested(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    """Rows of arriving files as messages, each file once: ``output_location``, ``ledger_location``, ``prefixes``.

    The input has ``file_columns=true``.  ``header_map`` is JSON text from file header to field name;
    ``first_row_only=true`` keeps the first row of each file.
    """
    ledger.ingest_batch(
        df, json.loads(properties.get("header_map", "{}")), column_list(properties["prefixes"]), properties["ledger_location"],
        properties["output_location"], str(batch_id), flag(properties, "first_row_only"))


@SINKS.register("noop")
def write_noop(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    df.select(*[F.col(f"`{c}`") for c in df.columns]).write.format("noop").mode("overwrite").save()
