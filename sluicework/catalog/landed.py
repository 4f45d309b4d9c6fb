"""Landed exports and fetched rows: XML, CSV lines, change events, calls, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.catalog.core import Catalog, table
from sluicework.catalog.fixtures import MICROS, part_xml
from sluicework.operators import columns
from sluicework.sources import fetched, reports
from sluicework.sources.changes import read_changes
from sluicework.sources.xmlrecords import xml_rows

CATALOG = Catalog()


@CATALOG.query("xml_extract", """
  SELECT p_partkey AS id, p_name AS name, CAST(trunc(p_retailprice) AS DECIMAL(12,2)) AS price, 'part' AS kind FROM part
  UNION ALL SELECT -p_partkey - 1, p_brand, NULL, 'part' FROM part WHERE p_partkey % 9 <> 0
""")
def xml_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Records of namespaced XML pages by XPath, empty records dropped, typed."""
    paths = {"id": "//pc:record/pc:id", "name": "//pc:record/pc:name", "price": "//pc:record/pc:price",
             "kind": "//pc:record/@kind"}
    rows = xml_rows(part_xml(spark, folder), "xml", "//pc:record", paths)
    schema = T.StructType.fromDDL("id BIGINT, name STRING, price DECIMAL(12,2), kind STRING")
    return columns.cast_text_record(rows, schema)


@CATALOG.query("csv_lines", """
  SELECT c_custkey AS "UserId", c_name AS "DisplayName", c_mktsegment AS "Segmentofuser", c_nationkey AS "Nation"
  FROM customer
""")
def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Report lines with repeated header lines, names cleaned, types inferred."""
    header = 'User Id,Display Name,"Segment, of user",Nation'
    body = table(spark, folder, "customer").select(F.to_csv(
        F.struct("c_custkey", "c_name", "c_mktsegment", "c_nationkey")).alias("value"))
    headers = table(spark, folder, "nation").select(F.lit(header).alias("value"))
    return reports.csv_lines(body.unionByName(headers), header).select(
        F.col("UserId").cast("bigint").alias("UserId"), "DisplayName", "Segmentofuser", "Nation")


@CATALOG.query("csv_lines_typed", """
  SELECT s_suppkey AS "UserId", s_name AS "DisplayName", s_acctbal AS "Balance" FROM supplier
""")
def csv_lines_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with declared types, parsed in place."""
    body = table(spark, folder, "supplier").select(
        F.to_csv(F.struct("s_suppkey", "s_name", "s_acctbal")).alias("value"))
    return reports.csv_lines(body, "User Id,Display Name,Balance", {"UserId": "BIGINT", "Balance": "DOUBLE"})


@CATALOG.query("cdc_events", """
  SELECT event_id AS replay_id, 'topic-' || event_id % 2 AS topic, user_id, event_type FROM events
  WHERE event_id > 250 AND event_id % 2 = 1
""")
def cdc_events(spark: SparkSession, folder: str) -> DataFrame:
    """Change events of one topic after a replay id."""
    lines = table(spark, folder, "events").select(F.to_json(F.struct(
        F.concat(F.lit("topic-"), (F.col("event_id") % 2).cast("string")).alias("topic"),
        F.col("event_id").alias("replay_id"),
        F.struct("user_id", "event_type").alias("payload"))).alias("value"))
    schema = "topic STRING, replay_id BIGINT, payload STRUCT<user_id: BIGINT, event_type: STRING>"
    return reports.change_events(lines, schema, "topic-1", 250).select("replay_id", "topic", "payload.*")


@CATALOG.query("rest_rows", """
  SELECT c_custkey AS id, lower(c_mktsegment) AS segment, 'GET' AS method FROM customer
""")
def rest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Landed responses of a service, typed by a schema."""
    body = F.struct(F.col("c_custkey").alias("id"), F.lower("c_mktsegment").alias("segment"), F.lit("GET").alias("method"))
    responses = table(spark, folder, "customer").select(
        F.to_json(body).alias("body"), F.lit(200).alias("code"), F.lit("{}").alias("headers"),
        F.lit(None).cast("string").alias("location"))
    return fetched.response_rows(responses, "BODY", "id BIGINT, segment STRING, method STRING")


@CATALOG.query("paged_export", """
  SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum,
         CAST(count(DISTINCT event_id // 500) AS BIGINT) AS pages FROM events GROUP BY event_type
""")
def paged_export(spark: SparkSession, folder: str) -> DataFrame:
    """Landed pages of JSON records, one record per row."""
    pages = table(spark, folder, "events").select(
        F.expr("event_id div 500 + 1").alias("page"), F.to_json(F.struct("event_id", "event_type")).alias("value"))
    record = F.from_json("value", "event_id BIGINT, event_type STRING")
    return pages.select("page", record.alias("r")).groupBy(F.col("r.event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("r.event_id").alias("id_sum"), F.countDistinct("page").alias("pages"))


@CATALOG.query("ranged_log", """
  SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
  WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 12:30:00'
""")
def ranged_log(spark: SparkSession, folder: str) -> DataFrame:
    """A half-open time range of a landed log, by a pushed filter."""
    rows = read_changes(spark, {
        "path": f"{folder}/events.parquet", "ts_col": "ts", "start_time": "2024-01-05T00:00:00Z",
        "end_time": "2024-01-12T12:30:00Z", "buffer_size": str(10**12)})
    return rows.select("event_id", "event_type", F.date_format("ts", MICROS).alias("ts"))


@CATALOG.query("xml_paths", """
  SELECT part, p_partkey, id, name, kind FROM (
    SELECT 'b' AS part, p_partkey, CAST(p_partkey AS VARCHAR) AS id, p_name AS name, 'outer' AS kind FROM part
    UNION ALL SELECT 'b', p_partkey, '-' || p_partkey, p_brand, 'inner' FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT 'c', p_partkey, p_type, NULL, NULL FROM part)
""")
def xml_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Records by full path; two prefixes for one namespace, a namespace of its own, nested tags of one name."""
    key = F.col("p_partkey").cast("string")
    inner = F.when(F.col("p_partkey") % 3 == 0, F.concat(
        F.lit('<y:record kind="inner"><y:id>-'), key, F.lit("</y:id><y:name>"), F.col("p_brand"), F.lit("</y:name></y:record>"))
    ).otherwise(F.lit(""))
    pages = table(spark, folder, "part").select("p_partkey", F.concat(
        F.lit('<a xmlns:x="urn:one" xmlns:y="urn:one" xmlns:z="urn:two"><b><x:record kind="outer"><z:id>no</z:id><y:id>'), key,
        F.lit("</y:id>"), F.lit("<x:name>"), F.col("p_name"), F.lit("</x:name>"), inner, F.lit("</x:record></b><c><record><id>"),
        F.col("p_type"), F.lit("</id></record><z:record><id>no</id></z:record></c></a>")).alias("xml"))
    spaces = {"o": "urn:one", "none": ""}
    inside = {"id": "/o:record/o:id", "name": "/o:record/o:name", "kind": "/o:record/@kind"}
    parts = [
        xml_rows(pages, "xml", "//b//o:record", inside, spaces, ["p_partkey"]).select(F.lit("b").alias("part"), "*"),
        xml_rows(pages, "xml", "//c/none:record", {"id": "//id", "name": "//name", "kind": "/record/@kind"}, spaces,
                 ["p_partkey"]).select(F.lit("c").alias("part"), "*")]
    return parts[0].unionByName(parts[1])
