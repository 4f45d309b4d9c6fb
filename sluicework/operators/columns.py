"""Column names, composite keys, typed casts and null normalisation."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.text import pack

CASTABLE = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.BooleanType, T.DecimalType, T.TimestampType, T.DateType, T.StringType,
)


class ColumnNameError(ValueError):
    """Two columns would end up with one name."""


def lower_case_columns(df: DataFrame) -> DataFrame:
    names = [name.lower() for name in df.columns]
    if len(set(names)) != len(names):
        raise ColumnNameError(f"columns differ only by case: {df.columns}")
    return df.toDF(*names)


def clean_names(names: list[str], replace_with: str = "") -> list[str]:
    """Drop characters outside ``a-zA-Z0-9``; repeats get ``_2``, ``_3`` ..."""
    taken: set[str] = set()
    result = []
    for name in names:
        base = re.sub("[^a-zA-Z0-9]", replace_with, name)
        candidate, number = base, 1
        while candidate.lower() in taken:
            number += 1
            candidate = f"{base}_{number}"
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def clean_column_names(df: DataFrame, replace_with: str = "") -> DataFrame:
    return df.toDF(*clean_names(df.columns, replace_with))


def rename_columns(df: DataFrame, header_map: Mapping[str, str]) -> DataFrame:
    """Display names -> field names; columns outside the map keep their name."""
    return df.withColumnsRenamed(dict(header_map))


def with_composite_id(df: DataFrame, name: str, *columns) -> DataFrame:
    return df.withColumn(name, pack(*columns))


def _typed(value: Column, field: T.StructField) -> Column:
    if not isinstance(field.dataType, CASTABLE):
        raise TypeError(f"column '{field.name}': unsupported data type {field.dataType.simpleString()}")
    if isinstance(field.dataType, T.StringType):
        return value
    text = F.regexp_replace(value, ",", "") if isinstance(field.dataType, T.DecimalType) else value
    typed = text.cast(field.dataType)
    return F.when(value == "", F.lit(None)).otherwise(typed) if field.nullable else typed


def cast_text_record(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All-string frame -> typed frame.

    Missing columns and nulls count as ``""``.  An empty string becomes null in
    a nullable non-string column; other text that does not parse is an error.
    """
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        value = F.coalesce(F.col(f"`{field.name}`"), F.lit("")) if field.name in present else F.lit("")
        columns.append(_typed(value, field).alias(field.name))
    return df.select(*columns)


def nullify(df: DataFrame) -> DataFrame:
    """NaN and the text ``nan``/``NaN``/``NaT`` become null, by column type."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)
        elif isinstance(field.dataType, T.StringType):
            value = F.when(~value.isin("nan", "NaN", "NaT"), value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def cast_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Target columns that the frame has, in target order and target type.

    Names match without regard to case; frame columns the target lacks drop out.
    """
    present = {name.lower(): name for name in df.columns}
    return df.select(*[
        F.col(f"`{present[field.name.lower()]}`").cast(field.dataType).alias(field.name)
        for field in target.fields
        if field.name.lower() in present
    ])
