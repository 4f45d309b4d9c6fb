"""Run monitoring: status, missed windows, log errors, incident suppression."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.operators.codec import expand_once
from sluicework.operators.skew import lookup_join
from sluicework.operators.upsert import latest_per_key
from sluicework.session import path_exists

RUN_WINDOW = "INTERVAL 1 HOUR"
SUPPRESS_SECONDS = 3600
PATTERNS = "errorLogPatterns"

# The page element that holds the log, and the text entities.
LOG_BODY = r'(?s)id="layout".*?<pre[^>]*>([^<]*)'
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _now(now: datetime | None) -> Column:
    return F.lit(now).cast("timestamp_ntz") if now is not None else F.current_timestamp().cast("timestamp_ntz")


def with_run_times(runs: DataFrame, columns: Sequence[str] = ("startedTime", "launchTime", "finishedTime")) -> DataFrame:
    """Epoch milliseconds -> timestamps."""
    return runs.withColumns({c: F.timestamp_millis(c) for c in columns if c in runs.columns})


def scheduled_runs(schedule: DataFrame, runs: DataFrame) -> DataFrame:
    """Every schedule row with its runs, never-run pipelines kept.

    The schedule is a lookup unique by name; runs of one name may be most of
    the table, so it is joined from the run side and never-run names are added.
    """
    if PATTERNS not in schedule.columns:
        schedule = schedule.withColumn(PATTERNS, F.lit(None).cast("array<string>"))
    matched = lookup_join(runs, schedule, ["name"])
    never = schedule.join(runs.select("name").distinct(), "name", "left_anti")
    return matched.unionByName(never, allowMissingColumns=True)


def latest_run(runs: DataFrame, batch: bool = False) -> DataFrame:
    """Newest run per name; batch pipelines go by finish time first."""
    order = ["finishedTime", "startedTime", "id"] if batch else ["startedTime", "id"]
    return latest_per_key(runs, ["name"], *[F.col(c).desc_nulls_last() for c in order])


def latest_status(schedule: DataFrame, runs: DataFrame, batch: bool = False) -> DataFrame:
    """Schedule with the newest run of each pipeline, one row per name."""
    if PATTERNS not in schedule.columns:
        schedule = schedule.withColumn(PATTERNS, F.lit(None).cast("array<string>"))
    return schedule.join(latest_run(runs, batch), "name", "left")


def not_running(status: DataFrame) -> DataFrame:
    """All but RUNNING/UNDEFINED; a pipeline that never ran is not running."""
    healthy = F.col("state").eqNullSafe("RUNNING") & F.col("finalStatus").eqNullSafe("UNDEFINED")
    return status.filter(~healthy)


def schedule_windows(schedule: DataFrame, day: Column) -> DataFrame:
    """``scheduledAt`` times of ``day`` -> ``name, startTime, endTime`` (one hour)."""
    exploded = schedule.select("name", day.alias("day"), F.explode("scheduledAt").alias("scheduledAt"))
    start = F.to_timestamp_ntz(F.concat_ws(" ", F.col("day").cast("string"), F.col("scheduledAt")), F.lit("yyyy-MM-dd HH:mm"))
    return exploded.select("name", start.alias("startTime"), (start + F.expr(RUN_WINDOW)).alias("endTime"))


def missed_windows(windows: DataFrame, runs: DataFrame, now: datetime | None = None) -> DataFrame:
    """Ended windows in which no run of that name started and finished.

    Runs are first reduced to one row per name and start minute (the earliest
    finish), because window starts fall on minutes.  Windows and runs then meet
    on name and hour, so a name with very many runs is spread over its hours.
    """
    ended = windows.filter(F.col("endTime") <= _now(now)).distinct()
    minutes = (
        runs.filter(F.col("finishedTime").isNotNull())
        .groupBy("name", F.date_trunc("minute", "startedTime").alias("minute"))
        .agg(F.min("finishedTime").alias("first_finish"))
        .withColumn("hour", F.date_trunc("hour", "minute"))
    )
    hours = F.array_distinct(F.array(F.date_trunc("hour", "startTime"), F.date_trunc("hour", "endTime")))
    spread = ended.withColumn("hour", F.explode(hours))
    inside = (F.col("minute") >= F.col("startTime")) & (F.col("first_finish") <= F.col("endTime"))
    hits = (
        spread.join(minutes, ["name", "hour"])
        .filter(inside)
        .select("name", "startTime")
        .distinct()
    )
    return ended.join(hits, ["name", "startTime"], "left_anti")


def log_text(column) -> Column:
    """Text of the page's log element up to its first child, entities decoded."""
    text = F.regexp_extract(column, LOG_BODY, 1)
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def log_errors(status: DataFrame, pages: DataFrame) -> DataFrame:
    """``id, name, has_error``: does any page of the newest attempt match a pattern?

    ``pages`` has ``id, attempt_id, html``; ``status`` is unique by id and only
    rows with patterns are looked at.
    """
    watched = status.filter(F.size(PATTERNS) > 0).select("id", "name", PATTERNS)
    newest = pages.groupBy("id").agg(F.max("attempt_id").alias("attempt_id"))
    watched_newest = watched.join(newest, "id")
    found = lookup_join(pages, watched_newest, ["id", "attempt_id"])
    # The text is taken out once per page, not once per pattern.
    bodies = expand_once(found, F.struct("id", "name", PATTERNS, log_text("html").alias("body")))
    checked = bodies.select("id", "name", F.exists(PATTERNS, lambda p: F.rlike("body", p)).alias("hit"))
    return checked.groupBy("id", "name").agg(F.bool_or("hit").alias("has_error"))


def incidents_to_raise(
    alerts: DataFrame, incidents: DataFrame, now: datetime | None = None, suppress_seconds: int = SUPPRESS_SECONDS,
) -> DataFrame:
    """Alerts whose app has no incident yet, or none within the last hour.

    ``alerts`` is unique by ``name``; ``incidents`` has ``appName, pdCreatedTime``.
    """
    last = incidents.groupBy(F.col("appName").alias("name")).agg(F.max("pdCreatedTime").alias("last_incident"))
    old = F.col("last_incident") < _now(now) - F.make_dt_interval(secs=F.lit(suppress_seconds))
    return alerts.join(last, "name", "left").filter(F.col("last_incident").isNull() | old)


def incident_rows(raised: DataFrame, app_type: str, now: datetime | None = None) -> DataFrame:
    """Raised alerts in the shape of the incident table."""
    return raised.select(
        F.col("id").alias("appId"), F.col("name").alias("appName"), F.lit(app_type).alias("appType"),
        F.col("state").alias("appState"), F.col("finalStatus").alias("appFinalStatus"),
        "startedTime", "launchTime", "finishedTime", "elapsedTime",
        F.md5(F.concat_ws("|", "name", _now(now).cast("string"))).alias("pdDedupKey"),
        _now(now).alias("pdCreatedTime"),
    )


def raise_incidents(
    alerts: DataFrame, table_path: str, app_type: str, batch_key: str, now: datetime | None = None,
) -> DataFrame:
    """One check: append the incidents to raise to the incident table and return them.

    Serves a scheduled check and ``foreachBatch`` alike.  The rows of a check are
    keyed by it and do not suppress its own replay.
    """
    spark = alerts.sparkSession
    if path_exists(spark, table_path):
        known = spark.read.parquet(table_path).filter(F.col("batch_id").cast("string") != batch_key)
    else:
        known = spark.createDataFrame([], "appName STRING, pdCreatedTime TIMESTAMP_NTZ")
    target = f"{table_path.rstrip('/')}/batch_id={batch_key}"
    incident_rows(incidents_to_raise(alerts, known, now), app_type, now).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
