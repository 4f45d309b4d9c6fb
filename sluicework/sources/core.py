"""Sources by format name: ``source(spark, properties) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from sluicework.plans.spec import substitute_all
from sluicework.registry import Registry

Source = Callable[[SparkSession, Mapping[str, str]], DataFrame]

SOURCES = Registry("source format")
STREAMS = Registry("stream format")


def read_input(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return SOURCES.get(properties["format"])(spark, substitute_all(properties, properties))


def read_stream(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return STREAMS.get(properties["format"])(spark, substitute_all(properties, properties))
