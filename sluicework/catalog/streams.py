"""Streaming specs drained over the tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, file_input, spec_document, stream_input, table
from sluicework.catalog.retries import failure_queue
from sluicework.operators import enrich, ledger
from sluicework.operators.snapshots import read_keyed
from sluicework.plans.hooks import hook
from sluicework.plans.spec import load_pipeline
from sluicework.session import shared_dir
from sluicework.sources.files import with_file_columns
from sluicework.streaming import incidents
from sluicework.streaming.runner import batch_key, drain, start_pipeline

CATALOG = Catalog()

ONCE = {"trigger": "available_now"}


def run_stream(spark: SparkSession, document: dict, enabled: dict[str, str]) -> None:
    name = next(iter(document["process"]))
    settings = {"checkpoint_dir": shared_dir(spark, f"checkpoint-{name}"), **enabled}
    query = start_pipeline(spark, load_pipeline(document, name), settings)
    if settings.get("trigger") == "available_now":
        query.awaitTermination()
    else:
        drain(query)


def file_output(location: str, query: str = "select * from #process") -> dict[str, str]:
    return {"query": query, "action": "file", "format": "parquet", "output_location": location, "idempotent": "true"}


@CATALOG.query("stream_equals_batch", """
  SELECT 'errors' AS part, event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
  FROM events WHERE event_type = 'error' GROUP BY 2
  UNION ALL SELECT 'large', event_type, CAST(count(*) AS BIGINT), CAST(sum(event_id) AS BIGINT)
  FROM events WHERE value > 100 GROUP BY 2
""")
def stream_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """One stream, two outputs per micro-batch."""
    errors, large = shared_dir(spark, "errors"), shared_dir(spark, "large")
    run_stream(spark, spec_document(
        "split_events", [stream_input(spark, folder, "events", max_files_per_trigger="1")],
        "SELECT event_id, event_type, value FROM events",
        [file_output(errors, "select * from #process where event_type = 'error'"),
         file_output(large, "select * from #process where value > 100")], "real"), ONCE)
    parts = [
        spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))
        .select(F.lit(part).alias("part"), "*")
        for part, path in (("errors", errors), ("large", large))
    ]
    return parts[0].unionByName(parts[1])


@CATALOG.query("stream_static_join", """
  SELECT c_mktsegment, event_type, CAST(count(*) AS BIGINT) AS n FROM events JOIN customer ON c_custkey = user_id GROUP BY 1, 2
""")
def stream_static_join(spark: SparkSession, folder: str) -> DataFrame:
    """The static side is read again for every micro-batch."""
    target = shared_dir(spark, "joined")
    run_stream(spark, spec_document(
        "join_users", [stream_input(spark, folder, "events"), file_input(folder, "customer")],
        "SELECT c_mktsegment, event_type, count(*) AS n FROM events JOIN customer ON c_custkey = user_id GROUP BY 1, 2",
        [file_output(target)], "BasicStreamingReal"), ONCE)
    return spark.read.parquet(target).groupBy("c_mktsegment", "event_type").agg(F.sum("n").alias("n"))


@CATALOG.query("stream_change_ranges", """
  SELECT CAST(least(epoch_us(ts) - epoch_us(lo), 28 * 86400000000) // (7 * 86400000000) AS INTEGER) AS batch_id,
         CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts
  FROM events, (SELECT min(ts) AS lo FROM events) m WHERE ts < TIMESTAMP '2024-02-01' GROUP BY 1
""")
def stream_change_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """From the earliest change, at most seven days per trigger."""
    target = shared_dir(spark, "changes")
    changes = {"format": "sfdc", "path": f"{folder}/events.parquet", "offset_column": "TS", "starting_offset": "earliest",
               "max_offset_days_per_trigger": "7", "until": "2024-02-01T00:00:00Z", "alias": "changes"}
    run_stream(spark, spec_document(
        "changes_by_week", [changes], "SELECT event_id, ts FROM changes", [file_output(target)], "real"), {})
    number = F.split_part("batch_id", F.lit("-"), F.lit(1)).cast("int").alias("batch_id")
    return spark.read.parquet(target).groupBy(number).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@CATALOG.query("stream_audit_ranges", """
  SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events
  WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' GROUP BY 1
""")
def stream_audit_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """An audit log from a given start, at most 600 minutes per trigger."""
    target = shared_dir(spark, "audit")
    audit = {"format": "okta", "path": f"{folder}/events.parquet", "offset_column": "ts",
             "starting_offset": "2024-01-10T00:00:00Z", "max_minutes_per_trigger": "600",
             "until": "2024-01-12T00:00:00Z", "alias": "audit"}
    run_stream(spark, spec_document(
        "audit_log", [audit], "SELECT event_type, ts FROM audit", [file_output(target)], "real"), {})
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@CATALOG.query("stream_upsert", """
  SELECT user_id, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'view')
  WHERE rn = 1
""")
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A stream into a keyed file table."""
    target = shared_dir(spark, "latest")
    run_stream(spark, spec_document(
        "latest_event", [stream_input(spark, folder, "events")],
        "SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'view'",
        [{"query": "select user_id, event_id from #process", "action": "keyed_file", "output_location": target,
          "mapping_id": "user_id", "order_by": "event_id", "buckets": "8"}], "real"), ONCE)
    return read_keyed(spark, target).select("user_id", "event_id")


@CATALOG.query("stream_retry", """
  SELECT event_id % 19 <> 0 AND epoch_ms(ts) < epoch_ms(TIMESTAMP '2024-01-15 11:58:00') AS due,
         CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1
""")
def stream_retry(spark: SparkSession, folder: str) -> DataFrame:
    """A failure queue split into due and waiting messages per micro-batch."""
    queue, target = shared_dir(spark, "queue"), shared_dir(spark, "due")
    failure_queue(spark, folder).write.parquet(queue)
    due = "coalesce(update_time < TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 2 MINUTES, false)"
    messages = {"format": "file", "file_format": "parquet", "path": queue, "schema_ddl": "key STRING, value STRING",
                "alias": "failures", "custom_preprocess_code_snippet": "catalog.unpack_failures"}
    run_stream(spark, spec_document(
        "retry_failures", [messages], "SELECT * FROM failures",
        [file_output(f"{target}/due", f"select meeting_id from #process where {due}"),
         file_output(f"{target}/waiting", f"select meeting_id from #process where not {due}")], "real"), ONCE)
    parts = [
        spark.read.parquet(f"{target}/{part}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(flag).alias("due"), "n")
        for part, flag in (("due", True), ("waiting", False))
    ]
    return parts[0].unionByName(parts[1])


@hook("catalog.unpack_failures")
def unpack_failures(df: DataFrame) -> DataFrame:
    return enrich.unpack_failures(df)


@hook("catalog.event_time")
def event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@CATALOG.query("stream_windows", """
  SELECT day_start, event_type, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT date_trunc('day', ts) AS day_start, event_type FROM events) e, (SELECT max(ts) AS top FROM events) m
  WHERE day_start + INTERVAL 1 DAY <= date_trunc('milliseconds', top) - INTERVAL 1 HOUR GROUP BY 1, 2
""")
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """A watermark lets spec SQL emit closed event-time windows."""
    target = shared_dir(spark, "windows")
    events = stream_input(spark, folder, "events", custom_preprocess_code_snippet="catalog.event_time")
    run_stream(spark, spec_document(
        "daily", [events],
        "SELECT window(ts, '1 day').start AS day_start, event_type, count(*) AS n FROM events GROUP BY window(ts, '1 day'), event_type",
        [file_output(target)], "real", watermark={"column": "ts", "delay": "1 hour"}), ONCE)
    return spark.read.parquet(target).select(F.col("day_start").cast("timestamp_ntz").alias("day_start"), "event_type", "n")


@CATALOG.query("stream_kafka_replay", """
  SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'click' AND event_id % 97 <> 0 GROUP BY 1
""")
def stream_kafka_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A message table streamed through decode, key filter and a message sink."""
    from sluicework.catalog.fixtures import kafka_events

    source, target = shared_dir(spark, "messages"), shared_dir(spark, "published")
    kafka_events(spark, folder).write.parquet(source)
    messages = {"format": "kafka", "topic": "events", "replay_path": source, "data_format": "json", "filter_value": "lic",
                "schema_ddl": "event_id BIGINT, event_type STRING", "alias": "events"}
    run_stream(spark, spec_document(
        "forward_clicks", [messages], "SELECT * FROM events WHERE event_id IS NOT NULL",
        [{"query": "select event_type, event_id from #process", "action": "WriteToKafka", "topic": "clicks",
          "replay_path": target, "kafka_partition_cols": "event_type"}], "real"), ONCE)
    published = spark.read.parquet(target).filter("topic = 'clicks'")
    return published.select(F.col("key").alias("event_type")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query("file_ingest", """
  SELECT '{"user_id":"' || c_custkey || '","display_name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS value
  FROM customer
""")
def file_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving CSV files to messages, each file once."""
    landing, out, book = shared_dir(spark, "landing"), shared_dir(spark, "out"), shared_dir(spark, "ledger")
    table(spark, folder, "customer").select(
        F.col("c_custkey").alias("User ID"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment, main"),
    ).write.option("header", True).csv(landing)
    headers = {"User ID": "user_id", "Name": "display_name", "Segment, main": "segment"}
    rows = (
        spark.readStream.schema("`User ID` STRING, `Name` STRING, `Segment, main` STRING")
        .option("header", True).option("pathGlobFilter", "part-*.csv").csv(landing)
        .transform(with_file_columns)
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        ledger.ingest_batch(batch, headers, ["part-"], book, out, batch_key(batch, batch_id))

    for _ in range(2):
        rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", shared_dir(spark, "ingest")).trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("value")


@CATALOG.query("stream_incidents", """
  WITH RECURSIVE alerts AS (SELECT 'app-' || user_id AS name, ts FROM events),
  raised AS (
    SELECT name, min(ts) AS ts FROM alerts GROUP BY name
    UNION ALL
    SELECT a.name, min(a.ts) FROM raised r JOIN alerts a ON a.name = r.name AND a.ts > r.ts + INTERVAL 1 HOUR GROUP BY a.name)
  SELECT name, ts AS alert_time FROM raised
""")
def stream_incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts suppressed on a stream that is stopped and started again between their files."""
    landing, target, checkpoint = (shared_dir(spark, name) for name in ("alerts", "raised", "checkpoint-alerts"))
    alerts = table(spark, folder, "events").select(
        F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("name"), F.col("ts").cast("timestamp").alias("alert_time"))
    source = {"format": "file", "file_format": "parquet", "path": landing, "schema_ddl": "name STRING, alert_time TIMESTAMP",
              "alias": "alerts", "custom_preprocess_code_snippet": "incidents.suppressed"}
    document = spec_document("raise_incidents", [source], "SELECT * FROM alerts", [file_output(target)], "real",
                             sql_conf={incidents.PROVIDER: incidents.STATE_STORE})
    days = F.dayofmonth("alert_time")
    for part in (days < 10, days.between(10, 19), days > 19):
        alerts.where(part).write.mode("append").parquet(landing)
        run_stream(spark, document, {**ONCE, "checkpoint_dir": checkpoint})
    return spark.read.parquet(target).select("name", F.col("alert_time").cast("timestamp_ntz").alias("alert_time"))


@CATALOG.query("stream_late_start", """
  SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts, CAST(sum(event_id) AS BIGINT) AS id_sum
  FROM events GROUP BY 1
""")
def stream_late_start(spark: SparkSession, folder: str) -> DataFrame:
    """A stream started on an empty table reads rows that arrive later with times before its start, each once."""
    landing, target, checkpoint = (shared_dir(spark, name) for name in ("late", "late-read", "checkpoint-late"))
    events = table(spark, folder, "events")
    changes = {"format": "changes", "path": landing, "offset_column": "ts", "starting_offset": "earliest",
               "max_offset_days_per_trigger": "500", "alias": "changes"}
    document = spec_document("late_start", [changes], "SELECT event_id, event_type, ts FROM changes", [file_output(target)], "real")
    for rows in (events.limit(0), events):
        rows.write.mode("append").parquet(landing)
        for _ in range(2):
            run_stream(spark, document, {**ONCE, "checkpoint_dir": checkpoint})
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("event_id").alias("id_sum"))


@CATALOG.query("file_ingest_first_row", """
  SELECT '{"user_id":"' || c_custkey || '","display_name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey % 4 ORDER BY c_custkey DESC) AS rn FROM customer) WHERE rn = 1
""")
def file_ingest_first_row(spark: SparkSession, folder: str) -> DataFrame:
    """From a spec alone, the first row of each arriving file; every file is read in several splits, and comes once."""
    landing, out, book, checkpoint = (shared_dir(spark, name) for name in ("first-landing", "first-out", "first-book", "first-checkpoint"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("User ID"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment, main"))
    source = {"format": "file", "file_format": "csv", "header": "true", "path": landing, "path_glob": "part-*.csv", "alias": "files",
              "schema_ddl": "`User ID` STRING, `Name` STRING, `Segment, main` STRING", "file_columns": "true"}
    sink = {"query": "select * from #process", "action": "ingest_files", "output_location": out, "ledger_location": book,
            "prefixes": "part-,member-", "first_row_only": "true",
            "header_map": '{"User ID": "user_id", "Name": "display_name", "Segment, main": "segment"}'}
    document = spec_document("first_rows", [source], "select * from files", [sink], "real", sql_conf={
        "spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "0"})
    for part in range(4):
        customers.where(F.col("User ID") % 4 == part).coalesce(1).sortWithinPartitions(F.col("User ID").desc()).write.mode(
            "append").option("header", True).csv(landing)
        if part % 2:
            run_stream(spark, document, {**ONCE, "checkpoint_dir": checkpoint})
    return spark.read.parquet(out).select("value")
