"""Reports and landed exports: CSV lines, JSON lines, cost pages, CDC events, XML."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators.codec import expand_once
from sluicework.operators.columns import cast_text_record, clean_column_names, clean_names
from sluicework.operators.costs import REPORT_SCHEMA
from sluicework.plans.spec import flag
from sluicework.session import read_text, shared_dir
from sluicework.sources.core import SOURCES, STREAMS
from sluicework.sources.files import declared_schema
from sluicework.sources.xmlrecords import xml_rows

# --- CSV --------------------------------------------------------------------


def csv_lines(lines: DataFrame, header: str, types: Mapping[str, str] | None = None, delimiter: str = ",") -> DataFrame:
    """Report lines (``value``) -> rows with cleaned column names.

    Lines equal to the header are dropped wherever they stand, so parts of one
    report may be unioned.  With ``types`` (clean name -> type) the lines are
    parsed in place; otherwise they are staged once and inferred.
    """
    spark = lines.sparkSession
    titles = next(iter(_split_header(header, delimiter)))
    names = clean_names(titles)
    body = lines.filter((F.col("value") != header) & (F.trim("value") != ""))
    if types is not None:
        schema = ", ".join(f"`{name}` {types.get(name, 'STRING')}" for name in names)
        return expand_once(body, F.from_csv("value", F.lit(schema), {"sep": delimiter}))
    path = shared_dir(spark, "report")
    body.select("value").write.text(path)
    return spark.read.option("inferSchema", True).option("delimiter", delimiter).csv(path).toDF(*names)


def _split_header(header: str, delimiter: str):
    import csv
    import io

    return csv.reader(io.StringIO(header), delimiter=delimiter)


@SOURCES.register("o365", "report")
def read_report(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Landed report files with a header line each, names cleaned."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(properties["uri"])
    return clean_column_names(df, properties.get("replace_with", ""))


# --- JSON lines, cost pages, events ------------------------------------------


@SOURCES.register("peopleai", "json_lines")
def read_json_lines(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Landed export lines typed by the declared schema."""
    schema = declared_schema(properties)
    if schema is None:
        return spark.read.json(properties["path"])
    return expand_once(spark.read.text(properties["path"]), F.from_json("value", schema))


@SOURCES.register("cost_report")
def read_cost_pages(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(properties["path"])


REPLAY_ALL = -2
REPLAY_NEW = -1


def change_events(lines: DataFrame, schema: T.StructType | str, topic: str | None = None, replay_from: int = REPLAY_ALL) -> DataFrame:
    """JSON change events -> ``replay_id, topic`` and the typed payload.

    ``replay_from`` keeps events after that id; -2 keeps all of them.  New-only
    (-1) is the stream's own starting position and filters nothing here.
    """
    parsed = expand_once(lines, F.from_json("value", schema))
    if topic is not None:
        parsed = parsed.filter(F.col("topic") == topic)
    return parsed.filter(F.col("replay_id") > replay_from) if replay_from >= 0 else parsed


@STREAMS.register("cdc")
def stream_changes(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    lines = spark.readStream.text(properties["path"])
    schema = declared_schema(properties)
    return change_events(lines, schema, properties.get("topic"), int(properties.get("replay_from", REPLAY_ALL)))


# --- XML --------------------------------------------------------------------


def read_pairs(text: str) -> dict[str, str]:
    """A two-column map file; lines that start with ``#`` are comments."""
    rows = csv.reader((line for line in io.StringIO(text) if line[:1] != "#"), skipinitialspace=True)
    named = [row for row in rows if any(cell.strip() for cell in row)]
    odd = [row for row in named if len(row) != 2]
    if odd:
        raise ValueError(f"a map file has two columns, not {len(odd[0])}: {odd[0]}")
    return {name.strip(): value.strip() for name, value in named}


@SOURCES.register("netsuite", "xml")
def read_xml(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Landed XML pages, records by ``recordTagPath``, columns by ``xpathMap``, prefixes by ``namespacePrefixMap``.

    ``mode=DROPMALFORMED`` leaves out pages that are not well-formed.
    """
    maps = []
    for name in ("xpathMap", "namespacePrefixMap"):
        maps.append(read_pairs(read_text(spark, properties[name]) or "") if name in properties else {})
    xpaths, namespaces = maps
    pages = spark.read.option("wholetext", True).text(properties["path"])
    flat = xml_rows(pages, "value", properties.get("recordTagPath", "//platformCore:record"), xpaths, namespaces,
                    malformed="drop" if properties.get("mode", "").upper() == "DROPMALFORMED" else "fail")
    schema = declared_schema(properties)
    return cast_text_record(flat, schema) if schema is not None and not flag(properties, "raw") else flat
