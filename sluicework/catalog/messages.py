"""Message codecs, offsets, column operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.catalog.core import Catalog, table
from sluicework.catalog.fixtures import kafka_events
from sluicework.functions import dates
from sluicework.functions.text import pack, unpack
from sluicework.operators import codec, columns, offsets
from sluicework.session import shared_dir

CATALOG = Catalog()

EVENT_SCHEMA = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@CATALOG.query("kafka_json_decode", """
  SELECT CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
         CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN event_type END AS event_type,
         CASE WHEN ok THEN value END AS value, CASE WHEN ok THEN props END AS props
  FROM (SELECT *, event_id % 97 <> 0 AS ok FROM events)
""")
def kafka_json_decode(spark: SparkSession, folder: str) -> DataFrame:
    """JSON values to flat columns, malformed values to null rows."""
    return codec.decode(kafka_events(spark, folder), "json", EVENT_SCHEMA)


@CATALOG.query("kafka_text_decode", """
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS broken
  FROM events
""")
def kafka_text_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Values as text."""
    rows = codec.decode(kafka_events(spark, folder), "text")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") == "{broken").alias("broken"))


@CATALOG.query("kafka_key_filter", """
  SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events
  WHERE contains(event_type, 'ic') AND event_id % 97 <> 0 GROUP BY event_type
""")
def kafka_key_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Key filter before the decode."""
    rows = codec.decode(kafka_events(spark, folder), "json", EVENT_SCHEMA, filter_value="ic")
    return rows.filter("event_id IS NOT NULL").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query("kafka_json_encode", """
  SELECT concat_ws(':', event_type, CASE WHEN event_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END) AS key,
         '{"event_id":' || event_id || ',"event_type":"' || event_type || '"' ||
         CASE WHEN event_id % 10 <> 0 THEN ',"user_id":' || user_id ELSE '' END || '}' AS value
  FROM events
""")
def kafka_json_encode(spark: SparkSession, folder: str) -> DataFrame:
    """K3, K4: keys joined by ':' without nulls, JSON values without null fields."""
    rows = table(spark, folder, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("user_id"))
    return codec.encode(rows, "json", ["event_type", "user_id"])


@CATALOG.query("kafka_json_roundtrip", """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def kafka_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """K4 then S10 gives the rows back."""
    rows = table(spark, folder, "orders").drop("o_orderdate")
    return codec.decode(codec.encode(rows, "json", ["o_orderkey"]), "json", rows.schema)


@CATALOG.query("kafka_text_encode", """
  SELECT CAST(n_regionkey AS VARCHAR) AS key, n_name AS value FROM nation
  UNION ALL SELECT 'fail', c_name FROM customer
""")
def kafka_text_encode(spark: SparkSession, folder: str) -> DataFrame:
    """K5: key from columns, or the key column the rows already have."""
    nation = table(spark, folder, "nation").withColumnRenamed("n_name", "value")
    customer = table(spark, folder, "customer").select(F.lit("fail").alias("key"), F.col("c_name").alias("value"))
    return codec.encode(nation, "text", ["n_regionkey"]).unionByName(codec.encode(customer, "text"))


CONNECT_SCHEMA = (
    '{"type":"struct","fields":[{"type":"int64","optional":false,"field":"p_partkey"},'
    '{"type":"string","optional":true,"field":"p_name"}],"optional":false,"name":"part"}'
)


@CATALOG.query("kafka_connect_envelope", """
  SELECT CAST(p_partkey AS VARCHAR) AS key,
         '{"schema":{"fields":[{"field":"p_partkey","optional":false,"type":"int64"},' ||
         '{"field":"p_name","optional":true,"type":"string"}],"name":"part","optional":false,"type":"struct"},' ||
         '"payload":{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '"}}' AS value
  FROM part
""")
def kafka_connect_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """K7: lower-cased columns inside a schema/payload envelope."""
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("P_PartKey"), F.col("p_name").alias("P_NAME"))
    return codec.encode(rows, "json_connect", ["p_partkey"], CONNECT_SCHEMA)


@CATALOG.query("kafka_next_offsets", """
  SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, CAST(max(event_id // 4) + 1 AS BIGINT) AS next_offset
  FROM events GROUP BY 2
""")
def kafka_next_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """One past the last offset read, per partition."""
    return offsets.next_offsets(kafka_events(spark, folder))


@CATALOG.query("kafka_resume", """
  SELECT CAST(event_id % 4 AS INTEGER) AS partition, CAST(count(*) AS BIGINT) AS n, CAST(min(event_id // 4) AS BIGINT) AS first_offset
  FROM events WHERE event_id // 4 >= CASE WHEN event_id % 4 < 2 THEN 100 ELSE 0 END GROUP BY 1
""")
def kafka_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Commit what a first read saw, then read on from there."""
    rows = kafka_events(spark, folder)
    commits = shared_dir(spark, "commits")
    seen = rows.filter((F.col("partition") < 2) & (F.col("offset") < 100))
    offsets.commit_offsets(offsets.next_offsets(seen), commits, "readers", "first")
    done = offsets.committed_offsets(spark, commits, "readers", "events")
    return offsets.after_offsets(rows, done).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"))


@CATALOG.query("kafka_resume_all", """
  SELECT p AS partition, CASE WHEN p < 2 THEN least(max(event_id // 4) + 1, 100) ELSE -2 END AS start_offset
  FROM (SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id FROM events
        UNION ALL SELECT CAST(n_nationkey AS INTEGER) + 4, 0 FROM nation WHERE n_nationkey < 2) x GROUP BY p
""")
def kafka_resume_all(spark: SparkSession, folder: str) -> DataFrame:
    """Start offsets name all partitions, also those without committed rows."""
    rows = kafka_events(spark, folder)
    seen = rows.filter((F.col("partition") < 2) & (F.col("offset") < 100))
    added = table(spark, folder, "nation").filter("n_nationkey < 2").select(
        F.lit("events").alias("topic"), (F.col("n_nationkey") + 4).cast("int").alias("partition"))
    partitions = rows.select("topic", "partition").distinct().unionByName(added)
    starts = offsets.start_offsets(partitions, offsets.next_offsets(seen))
    return starts.select("partition", F.col("next_offset").alias("start_offset"))


@CATALOG.query("columns_clean", """
  SELECT c_custkey AS "UserId", c_name AS "DisplayName", c_mktsegment AS "PercentofmessagesDMs", c_nationkey AS "UserId_2"
  FROM customer
""")
def columns_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Report headers without spaces and punctuation."""
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("User Id"), F.col("c_name").alias("Display-Name"),
        F.col("c_mktsegment").alias("Percent of messages, DMs"), F.col("c_nationkey").alias("User.Id"))
    return columns.clean_column_names(rows)


@CATALOG.query("columns_lower", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def columns_lower(spark: SparkSession, folder: str) -> DataFrame:
    """T3."""
    rows = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("S_SuppKey"), F.col("s_name").alias("S_NAME"), "s_nationkey")
    return columns.lower_case_columns(rows)


@CATALOG.query("columns_renamed", """
  SELECT c_custkey AS user_id, c_name AS display_name, c_mktsegment AS claimed_date FROM customer
""")
def columns_renamed(spark: SparkSession, folder: str) -> DataFrame:
    """Display names to field names by a header map."""
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("User ID"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("claimed_date"))
    return columns.rename_columns(rows, {"User ID": "user_id", "Name": "display_name"})


@CATALOG.query("typed_cast", """
  SELECT p_partkey, p_name, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS p_size,
         CAST(trunc(p_retailprice) AS DECIMAL(12,2)) AS price, '' AS missing_text, CAST(NULL AS INTEGER) AS missing_number
  FROM part
""")
def typed_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Text records to types; empty text to null, thousands separators dropped."""
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string"), "p_name",
        F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.format_number(F.col("p_retailprice").cast("bigint"), 0).alias("price"))
    schema = T.StructType.fromDDL(
        "p_partkey BIGINT, p_name STRING, p_size INT, price DECIMAL(12,2), missing_text STRING, missing_number INT")
    return columns.cast_text_record(rows, schema)


@CATALOG.query("composite_id", """
  SELECT l_orderkey, l_linenumber, l_partkey,
         concat_ws('~~', CAST(l_orderkey AS VARCHAR), CASE WHEN l_linenumber <> 3 THEN CAST(l_linenumber AS VARCHAR) END,
                   CAST(l_partkey AS VARCHAR)) AS id
  FROM lineitem
""")
def composite_id(spark: SparkSession, folder: str) -> DataFrame:
    """Parts joined by '~~', nulls skipped."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return columns.with_composite_id(
        rows, "id", F.col("l_orderkey").cast("string"),
        F.when(F.col("l_linenumber") != 3, F.col("l_linenumber").cast("string")), F.col("l_partkey").cast("string"))


@CATALOG.query("pack_unpack", """
  SELECT CAST(event_id AS VARCHAR) AS first, event_type AS second,
         CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS third
  FROM events
""")
def pack_unpack(spark: SparkSession, folder: str) -> DataFrame:
    """Pack and take apart; a part that is not there is null."""
    key = F.col("event_id")
    packed = table(spark, folder, "events").select(pack(
        key.cast("string"), "event_type", F.when(key % 2 == 0, F.col("user_id").cast("string"))).alias("value"))
    return packed.select(
        unpack("value", 0).alias("first"), unpack("value", 1).alias("second"), unpack("value", 2).alias("third"))


@CATALOG.query("null_normalise", """
  SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value,
         CASE WHEN event_id % 4 <> 0 THEN event_type END AS event_type FROM events
""")
def null_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """NaN and the text 'nan' become null."""
    key = F.col("event_id")
    rows = table(spark, folder, "events").select(
        "event_id", F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(key % 4 == 0, "nan").otherwise(F.col("event_type")).alias("event_type"))
    return columns.nullify(rows)


@CATALOG.query("time_formats", """
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS spaced, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
         strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS later,
         strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted
  FROM events
""")
def time_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Both text forms, one second later, another zone."""
    iso = F.date_format("ts", dates.ISO_FORMAT)
    spaced = F.date_format("ts", dates.SPACE_FORMAT)
    rows = table(spark, folder, "events").select("event_id", iso.alias("iso_in"), spaced.alias("space_in"))
    return rows.select(
        "event_id", dates.iso_to_space("iso_in").alias("spaced"), dates.space_to_iso("space_in").alias("iso"),
        F.date_format(dates.plus_one_second(dates.parse_any("iso_in")), dates.SPACE_FORMAT).alias("later"),
        F.date_format(dates.shift_zone(dates.parse_any("iso_in"), "Etc/GMT+5"), dates.SPACE_FORMAT).alias("shifted"))
