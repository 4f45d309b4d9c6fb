"""JDBC sink: insert, keyed upsert, cast to target, reload window."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.dates import last_days_start
from sluicework.operators.columns import cast_to_target
from sluicework.operators.upsert import latest_per_key, tie_break
from sluicework.plans.spec import column_list, flag, save_mode
from sluicework.sinks.core import SINKS

BATCH_ROWS = 100


def connection_options(properties: Mapping[str, str]) -> dict[str, str]:
    names = {"url": "url", "driver": "driver", "user": "user", "password": "password", "database": "dbname"}
    return {option: properties[key] for key, option in names.items() if properties.get(key)}


@contextmanager
def connection(spark: SparkSession, properties: Mapping[str, str]):
    """A driver-side JDBC connection for the few statements Spark does not issue."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(properties["driver"])
    args = [properties["url"]]
    if properties.get("user"):
        args += [properties["user"], properties.get("password", "")]
    handle = jvm.java.sql.DriverManager.getConnection(*args)
    try:
        yield handle
    finally:
        handle.close()


def execute(spark: SparkSession, properties: Mapping[str, str], statements: Iterable[str]) -> None:
    with connection(spark, properties) as handle:
        statement = handle.createStatement()
        for text in statements:
            statement.execute(text)
        statement.close()


def target_schema(spark: SparkSession, properties: Mapping[str, str]) -> T.StructType:
    return (
        spark.read.format("jdbc").options(**connection_options(properties))
        .option("query", f"select * from {properties['table_name']} where 1=0")
        .load().schema
    )


def delete_statement(table: str, column: str, days: int, now: datetime | None = None) -> str:
    start = last_days_start(days, now)
    return f"delete from {table} where {column} >= '{start:%Y-%m-%d %H:%M:%S}'"


def merge_statement(target: str, staged: str, columns: list[str], keys: list[str]) -> str:
    """One set-based MERGE from the staging table."""
    match = " and ".join(f"t.{k} = s.{k}" for k in keys)
    others = [c for c in columns if c not in keys]
    update = ", ".join(f"{c} = s.{c}" for c in others)
    matched = f" when matched then update set {update}" if others else ""
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"merge into {target} as t using {staged} as s on {match}{matched}"
        f" when not matched then insert ({names}) values ({values})"
    )


def _insert(df: DataFrame, table: str, properties: Mapping[str, str], mode: str) -> None:
    """One connection per task; ``writers`` bounds them by a shuffle, so what comes before stays wide."""
    rows = df.repartition(int(properties["writers"])) if "writers" in properties else df
    (
        rows.write.format("jdbc").mode(mode)
        .options(**connection_options(properties))
        .option("dbtable", table)
        .option("batchsize", properties.get("batchsize", "1000"))
        .save()
    )


def upsert(df: DataFrame, properties: Mapping[str, str]) -> None:
    """Keep one row per key, stage it from the executors, merge in the database."""
    keys = column_list(properties["key_cols"])
    order = column_list(properties.get("order_by"))
    rows = latest_per_key(df, keys, *[F.col(c).desc_nulls_last() for c in order], tie_break(df))
    target = properties["table_name"]
    staged = f"{target}_stage_{uuid.uuid4().hex[:12]}"
    spark = df.sparkSession
    execute(spark, properties, [f"create table {staged} as select * from {target} where 1=0"])
    try:
        _insert(rows, staged, {"batchsize": str(BATCH_ROWS), **properties}, "append")
        execute(spark, properties, [merge_statement(target, staged, df.columns, keys)])
    finally:
        execute(spark, properties, [f"drop table {staged}"])


@SINKS.register("rdb", "jdbc", "WriteToRDB")
def write_rdb(df: DataFrame, batch_id: object, properties: Mapping[str, str]) -> None:
    spark = df.sparkSession
    rows = cast_to_target(df, target_schema(spark, properties)) if flag(properties, "cast_to_table_schema") else df
    table = properties["table_name"]
    if "last_n_days" in properties:
        column = properties.get("ts_col", "systemmodstamp")
        execute(spark, properties, [delete_statement(table, column, int(properties["last_n_days"]))])
    operation = properties.get("operation", "insert")
    if operation == "insert":
        _insert(rows, table, properties, save_mode(properties))
    elif operation in ("upsert", "merge"):
        upsert(rows, properties)
    else:
        raise ValueError(f"unknown operation '{operation}'")
