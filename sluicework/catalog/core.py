"""Registered queries over the standard tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def decorate(fn: Query) -> Query:
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return decorate


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def file_input(folder: str, name: str, alias: str | None = None, **extra: str) -> dict[str, str]:
    """Batch input of a pipeline spec over one of the tables."""
    return {"format": "file", "file_format": "parquet", "path": f"{folder}/{name}.parquet",
            "alias": alias or name, **extra}


def stream_input(spark: SparkSession, folder: str, name: str, alias: str | None = None, **extra: str) -> dict[str, str]:
    """Streaming input of a pipeline spec over one of the tables."""
    return {"format": "file", "file_format": "parquet", "path": folder, "path_glob": f"{name}.parquet",
            "sample_path": f"{folder}/{name}.parquet", "alias": alias or name, **extra}


def spec_document(name: str, inputs: list, query: str, outputs: list, kind: str = "batch", **extra) -> dict:
    return {"appName": "catalog", "process": {name: {
        "class": kind, "input": inputs, "query": query, "output": outputs, **extra}}}
