"""Run status, missed windows, log errors, incidents, file ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, table
from sluicework.catalog.fixtures import log_pages, runs, schedule
from sluicework.operators import ledger, monitor

CATALOG = Catalog()

NOW = datetime(2024, 1, 30, 12, 0, 0)

RUNS = """(SELECT event_id AS id, event_type AS name, user_id, ts AS "startedTime",
  CASE WHEN event_id % 5 = 0 THEN 'RUNNING' ELSE 'FINISHED' END AS state,
  CASE event_id % 5 WHEN 0 THEN 'UNDEFINED' WHEN 1 THEN 'FAILED' ELSE 'SUCCEEDED' END AS "finalStatus",
  CASE WHEN event_id % 5 <> 0 THEN ts + to_minutes(event_id % 50) END AS "finishedTime" FROM events)"""

SCHEDULE = """(SELECT 'click' AS name, ['06:00', '18:30'] AS slots, ['timeout'] AS patterns
  UNION ALL SELECT 'purchase', ['00:00'], [] UNION ALL SELECT 'signup', ['12:15'], NULL
  UNION ALL SELECT 'nightly', ['23:30'], ['timeout', 'refused'])"""


@CATALOG.query("scheduled_runs", f"""
  SELECT s.name, r.id, r.state, coalesce(len(patterns), -1) AS patterns
  FROM {SCHEDULE} s LEFT JOIN {RUNS} r ON r.name = s.name
""")
def scheduled_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every schedule row with its runs, never-run pipelines kept."""
    joined = monitor.scheduled_runs(schedule(spark), runs(spark, folder))
    size = F.when(F.col(monitor.PATTERNS).isNull(), -1).otherwise(F.size(monitor.PATTERNS))
    return joined.select("name", "id", "state", size.cast("bigint").alias("patterns"))


@CATALOG.query("latest_run", f"""
  SELECT name, id, state, "startedTime" FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY "startedTime" DESC, id DESC) AS rn
    FROM (SELECT * REPLACE (name || '-' || user_id AS name) FROM {RUNS})) WHERE rn = 1
""")
def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    """Newest run per pipeline, here one pipeline per type and user."""
    return monitor.latest_run(user_runs(spark, folder)).select("name", "id", "state", "startedTime")


def user_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs(spark, folder).withColumn("name", F.concat_ws("-", "name", F.col("user_id").cast("string")))


@CATALOG.query("latest_batch_run", f"""
  SELECT name, id, "finishedTime" FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY "finishedTime" DESC NULLS LAST, "startedTime" DESC, id DESC) AS rn
    FROM {RUNS}) WHERE rn = 1
""")
def latest_batch_run(spark: SparkSession, folder: str) -> DataFrame:
    """Batch pipelines go by finish time first."""
    return monitor.latest_run(runs(spark, folder), batch=True).select("name", "id", "finishedTime")


NOT_RUNNING = f"""
  SELECT name, id, state, "startedTime" FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY "startedTime" DESC, id DESC) AS rn
    FROM (SELECT * REPLACE (name || '-' || user_id AS name) FROM {RUNS}))
  WHERE rn = 1 AND NOT (state = 'RUNNING' AND "finalStatus" = 'UNDEFINED')
"""


@CATALOG.query("not_running", f"{NOT_RUNNING} UNION ALL SELECT 'nightly', NULL, NULL, NULL")
def not_running(spark: SparkSession, folder: str) -> DataFrame:
    """Latest run not healthy, or never run."""
    mine = user_runs(spark, folder)
    plan = mine.select("name").distinct().unionByName(schedule(spark).filter("name = 'nightly'").select("name"))
    return monitor.not_running(monitor.latest_status(plan, mine)).select("name", "id", "state", "startedTime")


WINDOWS = f"""(SELECT name, start_ts, start_ts + INTERVAL 1 HOUR AS end_ts FROM (
  SELECT name, d + CAST(unnest(slots) || ':00' AS TIME) AS start_ts
  FROM {SCHEDULE} s, (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) x))"""


def windows(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "events").select(F.to_date("ts").alias("day")).distinct()
    plan = schedule(spark)
    per_day = days.withColumn("name", F.explode(F.array(*[F.lit(n) for n in ("click", "purchase", "signup", "nightly")])))
    return monitor.schedule_windows(per_day.join(plan, "name"), F.col("day"))


@CATALOG.query("schedule_expand", f'SELECT name, start_ts AS "startTime", end_ts AS "endTime" FROM {WINDOWS}')
def schedule_expand(spark: SparkSession, folder: str) -> DataFrame:
    """A one-hour window per scheduled time and day."""
    return windows(spark, folder)


@CATALOG.query("missed_runs", f"""
  SELECT name, start_ts AS "startTime", end_ts AS "endTime" FROM {WINDOWS} w
  WHERE end_ts <= TIMESTAMP '2024-01-30 12:00:00' AND NOT EXISTS (
    SELECT 1 FROM {RUNS} r WHERE r.name = w.name AND r."startedTime" >= start_ts AND r."finishedTime" <= end_ts)
""")
def missed_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Ended windows without a run inside them."""
    return monitor.missed_windows(windows(spark, folder), runs(spark, folder), NOW).select("name", "startTime", "endTime")


@CATALOG.query("log_error_match", r"""
  WITH logs AS (SELECT page_id % 50 AS id, (page_id // 50) % 3 AS attempt, html FROM pages),
       watched AS (SELECT DISTINCT id, CASE id % 3 WHEN 0 THEN ['track\([0-9]*7\)', 'no such text']
                     WHEN 1 THEN ['<title>[A-D]'] ELSE [] END AS patterns FROM logs)
  SELECT l.id, 'app' || l.id AS name,
         bool_or(len(list_filter(patterns, lambda p: regexp_matches(html, p))) > 0) AS has_error
  FROM logs l JOIN watched w ON w.id = l.id
  WHERE len(patterns) > 0 AND attempt = (SELECT max(attempt) FROM logs m WHERE m.id = l.id) GROUP BY l.id
""")
def log_error_match(spark: SparkSession, folder: str) -> DataFrame:
    """Whole log text of the newest attempt against any of the patterns."""
    pages = log_pages(spark, folder)
    texts = F.array(F.lit(r"track\([0-9]*7\)"), F.lit("no such text"))
    status = pages.select("id").distinct().select(
        "id", F.concat(F.lit("app"), F.col("id").cast("string")).alias("name"),
        F.when(F.col("id") % 3 == 0, texts).when(F.col("id") % 3 == 1, F.array(F.lit("<title>[A-D]")))
        .otherwise(F.array().cast("array<string>")).alias(monitor.PATTERNS))
    return monitor.log_errors(status, pages)


@CATALOG.query("incident_suppress", f"""
  SELECT name, id FROM ({NOT_RUNNING}) a
  LEFT JOIN (SELECT 'click-' || user_id AS app, max(ts) AS last FROM events WHERE event_type = 'error' GROUP BY 1) i ON i.app = a.name
  WHERE last IS NULL OR last < TIMESTAMP '2024-01-30 11:00:00'
""")
def incident_suppress(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts without an incident in the hour before."""
    alerts = monitor.not_running(monitor.latest_run(user_runs(spark, folder)))
    incidents = table(spark, folder, "events").filter("event_type = 'error'").select(
        F.concat(F.lit("click-"), F.col("user_id").cast("string")).alias("appName"), F.col("ts").alias("pdCreatedTime"))
    return monitor.incidents_to_raise(alerts, incidents, NOW).select("name", "id")


@CATALOG.query("epoch_times", """
  SELECT event_id AS id, date_trunc('milliseconds', ts) AS "startedTime" FROM events
""")
def epoch_times(spark: SparkSession, folder: str) -> DataFrame:
    """Epoch milliseconds to timestamps."""
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("startedTime"))
    return monitor.with_run_times(rows).withColumn("startedTime", F.col("startedTime").cast("timestamp_ntz"))


FILES = """(SELECT DISTINCT CASE WHEN user_id % 3 = 0 THEN 'other' ELSE 'analytics' END || '-' || user_id || '-' ||
  strftime(ts, '%Y-%m-%d') || CASE WHEN event_type = 'view' THEN '.csv.done' WHEN event_type = 'error' THEN '.txt'
  ELSE '.csv' END AS file_name, ts < TIMESTAMP '2024-01-20' AS known FROM events)"""


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", ".csv.done").when(F.col("event_type") == "error", ".txt").otherwise(".csv")
    prefix = F.when(F.col("user_id") % 3 == 0, "other").otherwise("analytics")
    return table(spark, folder, "events").select(
        F.concat(prefix, F.lit("-"), F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyy-MM-dd"), kind).alias("file_name"), "ts")


@CATALOG.query("ledger_new_files", f"""
  SELECT file_name, md5(file_name) AS guid, CAST(regexp_extract(file_name, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS DATE) AS extract_date
  FROM {FILES} WHERE NOT known AND file_name LIKE 'analytics-%' AND (file_name LIKE '%.csv' OR file_name LIKE '%.csv.done')
""")
def ledger_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted files that the ledger lacks."""
    files = ledger.accepted(arriving_files(spark, folder), ["analytics-", "member-"])
    known = ledger.ledger_entries(files.filter("ts < TIMESTAMP_NTZ '2024-01-20'").select("file_name").distinct())
    fresh = ledger.new_files(files.select("file_name"), known)
    return ledger.ledger_entries(fresh).select("file_name", "guid", "extract_date")


@CATALOG.query("ledger_unpushed", f"""
  SELECT file_name FROM {FILES} WHERE known AND file_name LIKE '%.csv.done' AND NOT contains(file_name, '-7-')
""")
def ledger_unpushed(spark: SparkSession, folder: str) -> DataFrame:
    """Files not pushed yet after some were marked."""
    files = arriving_files(spark, folder).filter("ts < TIMESTAMP_NTZ '2024-01-20'").select("file_name").distinct()
    entries = ledger.ledger_entries(files.filter(F.col("file_name").endswith(".csv.done")))
    pushed = files.filter(F.col("file_name").contains("-7-")).withColumn("pushed_at", F.lit(NOW).cast("timestamp"))
    return ledger.unpushed(ledger.mark_pushed(entries, pushed)).select("file_name")
