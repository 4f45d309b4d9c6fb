"""Meeting events: durations, timeliness, duration class and count labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.functions.dates import ISO_FORMAT
from sluicework.functions.text import count_label, pack, unpack

MEETING_EVENTS = ("meeting.started", "meeting.ended")
PARTICIPANT_EVENTS = ("meeting.participant_joined", "meeting.participant_left")


def _seconds(column: str):
    return F.unix_timestamp(F.try_to_timestamp(F.col(column), F.lit(ISO_FORMAT)))


def meeting_facts(events: DataFrame) -> DataFrame:
    """Adds ids, start/end seconds, duration, timeliness and duration class."""
    ended = F.col("event") == "meeting.ended"
    timed = (
        events.filter(F.col("event").isin(*MEETING_EVENTS))
        .withColumn("meetingUniqueId", pack("payload.object.id", "payload.object.uuid"))
        .withColumn("endTimeInSeconds", F.when(ended, _seconds("payload.object.end_time")))
        .withColumn("startTimeInSeconds", _seconds("payload.object.start_time"))
    )
    planned = F.col("payload.object.duration")
    actual = (F.col("endTimeInSeconds") - F.col("startTimeInSeconds")) / 60
    not_applicable = (F.col("event") == "meeting.started") | (planned == -1)
    return timed.select(
        "*",
        F.when(F.col("endTimeInSeconds").isNull(), 0.0).otherwise(actual).alias("durationInMinutes"),
        F.when(not_applicable, "NA").when(planned >= actual, "On-Time").otherwise("Over-Time").alias("timeliness"),
        F.when(not_applicable, "NA")
        .when(actual < 10, "<10 minutes")
        .when(actual <= 30, "10-30 minutes")
        .when(actual <= 60, "31-60 minutes")
        .otherwise("60+ minutes")
        .alias("breakDownByDuration"),
    )


def participant_facts(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event").isin(*PARTICIPANT_EVENTS)).withColumn(
        "participantUniqueId",
        pack("payload.object.id", "payload.object.uuid", "payload.object.participant.user_id"),
    )


def ended_meetings(events: DataFrame) -> DataFrame:
    """Lookup requests: one per ended meeting, first attempt."""
    return events.filter(F.col("event") == "meeting.ended").select(
        F.col("payload.object.id").alias("meeting_id"),
        F.col("payload.object.start_time").alias("start_time"),
        F.lit(0).alias("attempt"),
    )


def count_facts(messages: DataFrame) -> DataFrame:
    """Packed ``id~~start~~n`` -> labelled rows."""
    return messages.select(
        count_label(unpack("value", 2)).alias("participantBucket"),
        unpack("value", 0).alias("meetingId"),
        unpack("value", 1).alias("startTime"),
        pack(unpack("value", 0), unpack("value", 1)).alias("id"),
    )
