"""Run log: one append-only table of starts, ends and errors."""

from __future__ import annotations

import socket
import traceback
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

RUN_LOG_SCHEMA = (
    "dataset_id STRING, instance_id STRING, status STRING, logged_at TIMESTAMP, app_name STRING, app_id STRING,"
    " error_message STRING, stack_trace STRING, host_name STRING"
)


def record(
    spark: SparkSession, path: str | None, name: str, run_id: str, status: str, error: BaseException | None = None,
) -> None:
    """Append one row; without a path nothing is written."""
    if path is None:
        return
    stack = "".join(traceback.format_exception(error)) if error else None
    row = (
        name, run_id, status, datetime.now(UTC), spark.sparkContext.appName, spark.sparkContext.applicationId,
        str(error) if error else None, stack, socket.gethostname(),
    )
    spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def summary(failures: list[tuple[str, BaseException]]) -> str:
    """One line per failed pipeline: name, error type, first line of the message."""
    lines = [f"{name}: {type(error).__name__}: {(str(error).splitlines() or [''])[0]}" for name, error in failures]
    return "\n".join(lines)
