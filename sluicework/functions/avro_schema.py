"""Avro schema text -> Spark ``StructType``."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from sluicework.session import read_text

# Avro primitive names and the Spark types that carry them.
PRIMITIVES = {
    "null": T.NullType(),
    "string": T.StringType(),
    "enum": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "fixed": T.BinaryType(),
}

LOGICAL = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}


class AvroSchemaError(ValueError):
    """The Avro schema uses something that has no Spark type."""


def _convert(schema, names: dict) -> tuple[T.DataType, bool]:
    if isinstance(schema, str):
        if schema in PRIMITIVES:
            return PRIMITIVES[schema], schema == "null"
        if schema in names:
            return names[schema], False
        raise AvroSchemaError(f"unknown Avro type '{schema}'")
    if isinstance(schema, list):
        return _union(schema, names)
    kind = schema["type"]
    if isinstance(kind, (dict, list)):
        return _convert(kind, names)
    if kind == "record":
        fields = []
        for item in schema["fields"]:
            data_type, nullable = _convert(item["type"], names)
            fields.append(T.StructField(item["name"], data_type, nullable))
        result = T.StructType(fields)
        names[schema["name"]] = result
        return result, False
    if kind == "array":
        element, nullable = _convert(schema["items"], names)
        return T.ArrayType(element, nullable), False
    if kind == "map":
        value, nullable = _convert(schema["values"], names)
        return T.MapType(T.StringType(), value, nullable), False
    logical = schema.get("logicalType")
    if logical == "decimal" and kind in ("bytes", "fixed"):
        return T.DecimalType(schema["precision"], schema.get("scale", 0)), False
    if (kind, logical) in LOGICAL:
        return LOGICAL[kind, logical], False
    data_type, nullable = _convert(kind, names)
    if kind in ("enum", "fixed") and "name" in schema:
        names[schema["name"]] = data_type
    return data_type, nullable


def _union(branches: list, names: dict) -> tuple[T.DataType, bool]:
    present = [b for b in branches if b != "null"]
    nullable = len(present) < len(branches)
    if not present:
        return T.NullType(), True
    if len(present) == 1:
        return _convert(present[0], names)[0], nullable
    if all(isinstance(b, str) for b in present):
        if set(present) == {"int", "long"}:
            return T.LongType(), nullable
        if set(present) == {"float", "double"}:
            return T.DoubleType(), nullable
    members = [T.StructField(f"member{i}", _convert(b, names)[0], True) for i, b in enumerate(present)]
    return T.StructType(members), nullable


def struct_from_avro(text: str) -> T.StructType:
    """Convert Avro schema JSON; the top level must be a record."""
    result, _ = _convert(json.loads(text), {})
    if not isinstance(result, T.StructType):
        raise AvroSchemaError("the top-level Avro schema must be a record")
    return result


def struct_from_avsc(location: str, name: str | None = None) -> T.StructType:
    """Read ``location`` (or ``location/name.avsc``), on any file system of the session, and convert it."""
    path = f"{location}/{name}.avsc" if name else location
    text = read_text(SparkSession.active(), path)
    if text is None:
        raise FileNotFoundError(path)
    return struct_from_avro(text)
