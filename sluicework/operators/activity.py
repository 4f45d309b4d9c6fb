"""Nested activity records: five normalised tables and the activity fact."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.functions.text import join_texts
from sluicework.operators.codec import expand_once
from sluicework.operators.skew import lookup_join
from sluicework.plans.hooks import hook

# Source field -> output column, in output order.
GENERIC_FIELDS = {
    "source_id": "source_id",
    "type": "request_type",
    "created": "created_date",
    "subject": "subject",
    "summary": "summary",
    "direction": "direction",
    "timestamp": "event_timestamp",
    "ingest_timestamp": "ingest_timestamp",
    "tags": "tags",
    "in_reply_to_source_id": "in_reply_to_source_id",
    "follow_up_email_source_id": "follow_up_email_source_id",
    "reply_received": "reply_received",
    "attachment_file_names": "attachment_file_names",
    "start_time": "start_time",
    "end_time": "end_time",
    "duration": "duration",
    "all_day": "all_day",
    "location": "location",
    "followed_meeting_source_id": "followed_meeting_source_id",
    "outbound_phone_number": "outbound_phone_number",
    "status": "status",
}
# Fields of the nested records.
CAMPAIGN_FIELDS = {"crm_id": "crm_id", "name": "crm_name", "start_date": "start_date", "end_date": "end_date"}
PARTICIPANT_FIELDS = (
    "peopleai_id", "crm_id", "name", "title", "phone", "email",
    "role", "type", "time_spent", "team", "matched_as", "status",
)
STATS_FIELDS = (
    "total_participants", "internal_participants", "external_participants",
    "contacts_participants", "participants_on_to_line", "participants_on_cc_line",
    "accepted_participants", "declined_participants", "tentative_participants",
)
MATCHED_FIELDS = (
    "crm_id", "name", "email", "parent_account_crm_id", "parent_account_name", "stage_name", "stage_rank",
)
MATCH_KINDS = ("account", "lead", "opportunity")

RECORD_SCHEMA = """
  uid STRING, source_id STRING, type STRING, created STRING, subject STRING, summary STRING, direction STRING,
  timestamp STRING, ingest_timestamp STRING, tags ARRAY<STRING>, in_reply_to_source_id STRING,
  follow_up_email_source_id STRING, reply_received BOOLEAN, attachment_file_names ARRAY<STRING>,
  start_time STRING, end_time STRING, duration BIGINT, all_day BOOLEAN, location STRING,
  followed_meeting_source_id STRING, outbound_phone_number STRING, status STRING,
  campaigns ARRAY<STRUCT<crm_id: STRING, name: STRING, start_date: STRING, end_date: STRING>>,
  participants ARRAY<STRUCT<peopleai_id: STRING, crm_id: STRING, name: STRING, title: STRING, phone: STRING,
    email: STRING, role: STRING, type: STRING, time_spent: BIGINT, team: STRUCT<crm_id: STRING, name: STRING>,
    matched_as: STRING, status: STRING>>,
  stats STRUCT<total_participants: BIGINT, internal_participants: BIGINT, external_participants: BIGINT,
    contacts_participants: BIGINT, participants_on_to_line: BIGINT, participants_on_cc_line: BIGINT,
    accepted_participants: BIGINT, declined_participants: BIGINT, tentative_participants: BIGINT>,
  crm_status STRUCT<pushed: BOOLEAN, push_time: STRING, crm_id: STRING, matched_to: STRING,
    account: {matched}, lead: {matched}, opportunity: {matched}>
""".format(matched="""STRUCT<crm_id: STRING, name: STRING, email: STRING, parent_account_crm_id: STRING,
    parent_account_name: STRING, stage_name: STRING, stage_rank: BIGINT>""")
CORRUPT = "_corrupt_record"


def parse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines -> record structs plus the raw text of lines that are not JSON.

    A field of another type than declared becomes null and its record stays.
    """
    # As the only value of an object: text after a record then breaks the line, which a parser of one record would not see.
    opening = '{"r":'
    parsed = F.from_json(
        F.concat(F.lit(opening), F.col(column), F.lit("}")), f"r STRUCT<{RECORD_SCHEMA}>, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    # Spark also marks records with a field of another type; only text that is no JSON keeps the mark.
    rows = expand_once(lines, parsed)
    broken = F.when(F.get_json_object(CORRUPT, "$").isNull(), F.substr(
        CORRUPT, F.lit(len(opening) + 1), F.length(CORRUPT) - len(opening) - 1))
    return rows.select("r.*", broken.alias(CORRUPT))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull() & F.col("uid").isNotNull()).drop(CORRUPT)


def rejected_records(parsed: DataFrame) -> DataFrame:
    """Lines that are not JSON, or hold no ``uid``."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise("no_uid")
    return parsed.filter(F.col(CORRUPT).isNotNull() | F.col("uid").isNull()).select(
        reason.alias("reason"), F.col(CORRUPT).alias("line"))


def _generic(name: str) -> Column:
    return join_texts(name) if name in ("tags", "attachment_file_names") else F.col(name)


def _stamp(loaded_at: datetime | None) -> Column:
    return F.lit(loaded_at).cast("timestamp") if loaded_at is not None else F.current_timestamp()


def all_columns(loaded_at: datetime | None = None) -> list[Column]:
    return [F.col("uid"), *[_generic(source).alias(name) for source, name in GENERIC_FIELDS.items()],
            _stamp(loaded_at).alias("load_date_time")]


def campaign_columns(campaign: Column) -> list[Column]:
    return [F.col("uid"), *[campaign[source].alias(name) for source, name in CAMPAIGN_FIELDS.items()]]


def participant_columns(person: Column) -> list[Column]:
    return [F.col("uid"), *[
        (person["team"]["name"] if name == "team" else person[name]).alias(name) for name in PARTICIPANT_FIELDS]]


def stats_columns() -> list[Column]:
    return [F.col("uid"), F.col("type").alias("request_type"), *[F.col(f"stats.{name}").alias(name) for name in STATS_FIELDS]]


def matched_value(name: str) -> Column:
    """Field ``name`` of the struct that ``matched_to`` points at, else null."""
    result = F.lit(None)
    for kind in MATCH_KINDS:
        result = F.when(F.col("crm_status.matched_to") == kind, F.col(f"crm_status.{kind}.{name}")).otherwise(result)
    return result.alias(name)


def crm_columns() -> list[Column]:
    return [
        F.col("uid"),
        F.col("crm_status.pushed").alias("pushed"),
        F.col("crm_status.push_time").alias("push_time"),
        F.col("crm_status.crm_id").alias("task_id"),
        F.col("crm_status.matched_to").alias("matched_to"),
        F.col("crm_status.account.crm_id").alias("acc_crm_id"),
        F.col("crm_status.account.name").alias("acc_crm_name"),
        *[matched_value(name) for name in MATCHED_FIELDS],
    ]


def all_table(records: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return records.select(*all_columns(loaded_at))


def campaign_table(records: DataFrame) -> DataFrame:
    return records.select("uid", F.explode("campaigns").alias("c")).select(*campaign_columns(F.col("c")))


def participant_table(records: DataFrame) -> DataFrame:
    return records.select("uid", F.explode("participants").alias("p")).select(*participant_columns(F.col("p")))


def stats_table(records: DataFrame) -> DataFrame:
    return records.select(*stats_columns())


def crm_table(records: DataFrame) -> DataFrame:
    return records.select(*crm_columns())


def unmatched_crm(records: DataFrame) -> DataFrame:
    return crm_table(records.filter(F.col("crm_status.matched_to") == "none"))


def normalise(records: DataFrame, loaded_at: datetime | None = None) -> dict[str, DataFrame]:
    """The five tables of parsed records as frames, each a plan of its own.

    Lines that all five read are parsed once by staging the records; see :func:`table_of` and the hooks for specs.
    """
    return {
        "all": all_table(records, loaded_at),
        "campaign": campaign_table(records),
        "participant": participant_table(records),
        "activity": stats_table(records),
        "crm": crm_table(records),
    }


# Table -> its columns, in order.
TABLES = {
    "all": ("uid", *GENERIC_FIELDS.values(), "load_date_time"),
    "campaign": ("uid", *CAMPAIGN_FIELDS.values()),
    "participant": ("uid", *PARTICIPANT_FIELDS),
    "activity": ("uid", "request_type", *STATS_FIELDS),
    "crm": ("uid", "pushed", "push_time", "task_id", "matched_to", "acc_crm_id", "acc_crm_name", *MATCHED_FIELDS),
    "rejected": ("reason", "line"),
}


def table_of(parsed: DataFrame, table: str, loaded_at: datetime | None = None) -> DataFrame:
    """One of :data:`TABLES` out of parsed records; reads only the fields that it shows."""
    return rejected_records(parsed) if table == "rejected" else normalise(good_records(parsed), loaded_at)[table]


@hook("activity.records")
def records_hook(df: DataFrame) -> DataFrame:
    """For specs: a frame with the column ``value`` -> parsed records; share them by ``stage``."""
    return parse_records(df)


# For the outputs of such a spec: ``activity.all``, ``activity.campaign`` and so on.
for _table in TABLES:
    hook(f"activity.{_table}")(partial(table_of, table=_table))


def tagged_rows(lines: DataFrame, column: str = "value", loaded_at: datetime | None = None) -> DataFrame:
    """JSON lines -> ``table`` and the rows of all tables side by side, rejected lines included.

    A line is read and parsed once and explodes into its rows of every table; columns that a table lacks are null.
    Written once, partitioned by ``table``, this is what five reads of the lines would give; :func:`one_table` takes
    a table out again.  Each row is as wide as all tables together, so for many lines staged records cost less.
    """
    parsed = parse_records(lines, column)
    good = F.col(CORRUPT).isNull() & F.col("uid").isNotNull()
    wide = list(dict.fromkeys(name for names in TABLES.values() for name in names))
    kinds = {"reason": "string", "line": "string"}
    for frame in normalise(parsed, loaded_at).values():
        kinds |= dict(frame.dtypes)

    def row(table: str, columns: list[Column]) -> Column:
        held = dict(zip(TABLES[table], columns, strict=True))
        return F.struct(F.lit(table).alias("table"), *[
            held.get(name, F.lit(None)).cast(kinds[name]).alias(name) for name in wide])

    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise("no_uid")
    rows = F.concat(
        F.array(row("all", all_columns(loaded_at)), row("activity", stats_columns()), row("crm", crm_columns())),
        F.coalesce(F.transform("campaigns", lambda c: row("campaign", campaign_columns(c))), F.array()),
        F.coalesce(F.transform("participants", lambda p: row("participant", participant_columns(p))), F.array()))
    rejected = F.array(row("rejected", [reason, F.col(CORRUPT)]))
    return parsed.select(F.inline(F.when(good, rows).otherwise(rejected)))


@hook("activity.tables")
def tables_hook(df: DataFrame) -> DataFrame:
    """For specs: a frame with the column ``value``; write it partitioned by ``table``."""
    return tagged_rows(df)


def one_table(tagged: DataFrame, table: str) -> DataFrame:
    """The rows of one table with its own columns; reads that table's files only."""
    return tagged.filter(F.col("table") == table).select(*TABLES[table])


def by_uid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two tables of the same records, joined on ``uid``.

    Both sides grow with the records, but Spark takes parsed JSON for much smaller than it is and would send one
    side whole through the driver; both are sorted instead.
    """
    return left.join(right.hint("merge"), "uid")


def override_or_default(override: str, default: str) -> Column:
    """The override, unless it is null or zero."""
    return F.coalesce(F.nullif(F.col(override), F.lit(0).cast("double")), F.col(default))


def fiscal_cutoff(today: Column | None = None) -> Column:
    """Aug 1 of ``year(today - 1 year + 5 months) - 1``."""
    day = today if today is not None else F.current_date()
    return F.make_date(F.year(F.add_months(day, -7)) - 1, F.lit(8), F.lit(1))


def activity_fact(
    activities: DataFrame, crm: DataFrame, participants: DataFrame, accounts: DataFrame, users: DataFrame,
    cutoff: Column | None = None,
) -> DataFrame:
    """Internal participants of recent activities with account, owner and rep.

    Activities and crm rows are both unique by ``uid`` and are joined first, so
    the participants move on ``uid`` once.  Accounts and users are unique by key:
    every later join is a lookup, whose hot keys adaptive execution splits.
    """
    recent = activities.filter(F.col("event_timestamp") >= (cutoff if cutoff is not None else fiscal_cutoff()))
    internal = participants.filter(F.col("type") == "internal").select(
        "uid", F.col("email").alias("participant_email"), F.col("name").alias("participant_name"),
        F.col("type").alias("participant_type"), "time_spent")
    owned = crm.select("uid", F.col("acc_crm_id").alias("account_id"))
    reps = users.select(
        F.col("user_id").alias("rep_id"), F.col("user_name").alias("rep_name"), F.col("username").alias("participant_email"))
    owners = users.select(F.col("user_id").alias("account_owner_id"), F.col("user_name").alias("account_owner_name"))
    joined = by_uid(internal, by_uid(recent, owned))
    joined = lookup_join(joined, accounts, ["account_id"])
    joined = lookup_join(joined, reps, ["participant_email"], "left")
    joined = lookup_join(joined, owners, ["account_owner_id"], "left")
    return joined.withColumn("final_amount", override_or_default("amount_override", "amount")).withColumn(
        "actual_time_spent_in_sec",
        F.when(F.col("request_type") == "meeting", F.col("duration")).otherwise(F.col("time_spent")),
    )
