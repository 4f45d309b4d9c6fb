"""Nested records: activities, costs, accounts, audit events, meetings."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, file_input, spec_document, table
from sluicework.catalog.fixtures import (
    ISO, MEETING_SCHEMA, activity_lines, cost_pages, meeting_messages, orders_with_customer,
)
from sluicework.catalog.pipelines import through_spec
from sluicework.operators import activity, codec, costs, meeting
from sluicework.plans.runner import run_pipeline
from sluicework.plans.spec import load_pipeline
from sluicework.session import child_session, shared_dir, through_storage

CATALOG = Catalog()

LOADED_AT = datetime(2024, 5, 1, 12, 0, 0)

# Records that parse and have a uid, as flat rows.
GOOD = """(SELECT o.*, c.*, 'u' || o_orderkey AS uid, o_orderkey % 4 AS few, o_orderkey % 3 AS kind
  FROM orders o JOIN customer c ON o_custkey = c_custkey WHERE o_orderkey % 103 <> 0 AND o_orderkey % 101 <> 0)"""


def records(spark: SparkSession, folder: str) -> DataFrame:
    return activity.good_records(activity.parse_records(activity_lines(spark, folder)))


@CATALOG.query("norm_all", f"""
  SELECT uid, 's' || o_orderkey AS source_id, ['meeting', 'email', 'call'][kind + 1] AS request_type,
         strftime(o_orderdate, '%Y-%m-%d') AS created_date, o_orderpriority AS subject, CAST(NULL AS VARCHAR) AS summary,
         CAST(NULL AS VARCHAR) AS direction, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
         CAST(NULL AS VARCHAR) AS ingest_timestamp,
         CASE few WHEN 0 THEN NULL WHEN 1 THEN 't1' WHEN 2 THEN 't1,t2' ELSE 't1,t2,t3' END AS tags,
         CAST(NULL AS VARCHAR) AS in_reply_to_source_id, CAST(NULL AS VARCHAR) AS follow_up_email_source_id,
         o_orderkey % 2 = 0 AS reply_received,
         CASE WHEN o_orderkey % 5 = 0 THEN 'f.txt,g.txt' END AS attachment_file_names,
         CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS end_time,
         CAST(o_orderkey % 7200 AS BIGINT) AS duration, CAST(NULL AS BOOLEAN) AS all_day, CAST(NULL AS VARCHAR) AS location,
         CAST(NULL AS VARCHAR) AS followed_meeting_source_id, CAST(NULL AS VARCHAR) AS outbound_phone_number,
         o_orderstatus AS status, '2024-05-01 12:00:00' AS load_date_time
  FROM {GOOD}
""")
def norm_all(spark: SparkSession, folder: str) -> DataFrame:
    """Generic fields of every record."""
    return activity.all_table(records(spark, folder), LOADED_AT).withColumn(
        "load_date_time", F.date_format("load_date_time", "yyyy-MM-dd HH:mm:ss"))


@CATALOG.query("norm_campaign", f"""
  SELECT uid, 'c' || (o_orderkey + i) % 9 AS crm_id, 'Campaign ' || i AS crm_name,
         strftime(o_orderdate, '%Y-%m-%d') AS start_date, CAST(NULL AS VARCHAR) AS end_date
  FROM (SELECT *, unnest(range(1, CAST(kind + 1 AS BIGINT))) AS i FROM {GOOD})
""")
def norm_campaign(spark: SparkSession, folder: str) -> DataFrame:
    """One row per campaign."""
    return activity.campaign_table(records(spark, folder))


PARTICIPANTS = f"""(SELECT *, (o_orderkey + i) % 100 AS rep FROM
  (SELECT *, unnest(range(1, CAST(few + 1 AS BIGINT))) AS i FROM {GOOD}))"""


@CATALOG.query("norm_participant", f"""
  SELECT uid, 'p' || o_orderkey || '-' || i AS peopleai_id, CAST(NULL AS VARCHAR) AS crm_id, 'Name ' || i AS name,
         CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS phone, 'rep' || rep || '@example.com' AS email,
         CAST(NULL AS VARCHAR) AS role, CASE WHEN (o_orderkey + i) % 2 = 0 THEN 'internal' ELSE 'external' END AS type,
         CAST(o_orderkey * i % 600 AS BIGINT) AS time_spent, 'team' || i % 2 AS team,
         CAST(NULL AS VARCHAR) AS matched_as, CAST(NULL AS VARCHAR) AS status
  FROM {PARTICIPANTS}
""")
def norm_participant(spark: SparkSession, folder: str) -> DataFrame:
    """One row per participant, the team by its name."""
    return activity.participant_table(records(spark, folder))


@CATALOG.query("norm_stats", f"""
  SELECT uid, ['meeting', 'email', 'call'][kind + 1] AS request_type, CAST(few AS BIGINT) AS total_participants,
         CAST(o_orderkey % 2 AS BIGINT) AS internal_participants, CAST(NULL AS BIGINT) AS external_participants,
         CAST(NULL AS BIGINT) AS contacts_participants, CAST(NULL AS BIGINT) AS participants_on_to_line,
         CAST(NULL AS BIGINT) AS participants_on_cc_line, CAST(NULL AS BIGINT) AS accepted_participants,
         CAST(NULL AS BIGINT) AS declined_participants, CAST(NULL AS BIGINT) AS tentative_participants
  FROM {GOOD}
""")
def norm_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counters with the record type."""
    return activity.stats_table(records(spark, folder))


CRM_SQL = f"""
  SELECT uid, o_orderkey % 2 = 1 AS pushed, CAST(NULL AS VARCHAR) AS push_time, 'task' || o_orderkey AS task_id,
         ['none', 'account', 'lead', 'opportunity'][few + 1] AS matched_to,
         CASE WHEN o_orderkey % 6 <> 0 THEN 'a' || o_custkey END AS acc_crm_id,
         CASE WHEN o_orderkey % 6 <> 0 THEN c_name END AS acc_crm_name,
         CASE WHEN few = 1 AND o_orderkey % 6 <> 0 THEN 'a' || o_custkey WHEN few = 2 THEN 'l' || o_custkey
              WHEN few = 3 THEN 'o' || o_orderkey END AS crm_id,
         CASE WHEN few = 1 AND o_orderkey % 6 <> 0 THEN c_name WHEN few = 2 THEN c_name
              WHEN few = 3 THEN c_mktsegment END AS name,
         CASE WHEN few = 2 THEN 'lead' || o_custkey || '@example.com' END AS email,
         CAST(NULL AS VARCHAR) AS parent_account_crm_id, CAST(NULL AS VARCHAR) AS parent_account_name,
         CASE WHEN few = 3 THEN o_orderpriority END AS stage_name,
         CAST(CASE WHEN few = 3 THEN o_orderkey % 5 END AS BIGINT) AS stage_rank
  FROM {GOOD}
"""


@CATALOG.query("norm_crm", CRM_SQL)
def norm_crm(spark: SparkSession, folder: str) -> DataFrame:
    """Account columns and the columns of the matched struct."""
    return activity.crm_table(records(spark, folder))


@CATALOG.query("norm_crm_unmatched", f"SELECT * FROM ({CRM_SQL}) WHERE matched_to = 'none'")
def norm_crm_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Records matched to nothing."""
    return activity.unmatched_crm(records(spark, folder))


@CATALOG.query("norm_rejects", """
  SELECT CASE WHEN o_orderkey % 103 = 0 THEN 'malformed' ELSE 'no_uid' END AS reason, CAST(count(*) AS BIGINT) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 103 = 0 OR o_orderkey % 101 = 0 GROUP BY 1
""")
def norm_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are skipped, with the reason."""
    rejects = activity.rejected_records(activity.parse_records(activity_lines(spark, folder)))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _details(table_name: str, sql: str) -> str:
    names = [f'"{name}"' for name in activity.TABLES[table_name] if name not in ("uid", "load_date_time")]
    return f"SELECT '{table_name}' AS part, uid, concat_ws('|', {', '.join(names)}) AS detail FROM ({sql})"


@CATALOG.query("activity_tables", " UNION ALL ".join([
    *[_details(name, CATALOG.sql[query]) for name, query in (
        ("all", "norm_all"), ("campaign", "norm_campaign"), ("participant", "norm_participant"), ("activity", "norm_stats"),
        ("crm", "norm_crm"))],
    """SELECT 'rejected', NULL, CASE WHEN o_orderkey % 103 = 0 THEN 'malformed' ELSE 'no_uid' END
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 103 = 0 OR o_orderkey % 101 = 0"""]))
def activity_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Landed lines, parsed once and staged, into five tables and the rejected lines through one spec."""
    landing, target = shared_dir(spark, "activity-lines"), shared_dir(spark, "activity-tables")
    activity_lines(spark, folder).select("value").write.text(landing)
    document = spec_document(
        "activity_tables", [{"format": "file", "file_format": "text", "path": landing, "alias": "lines"}], "select value from lines",
        [{"query": "select * from #process", "action": "file", "format": "parquet", "output_location": f"{target}/{name}",
          "custom_postprocess_code_snippet": f"activity.{name}"} for name in activity.TABLES],
        custom_process_code_snippet="activity.records")
    run_pipeline(spark, load_pipeline(document, "activity_tables"), {"share_output": "stage"})
    parts = []
    for name, columns in activity.TABLES.items():
        rows = spark.read.parquet(f"{target}/{name}")
        shown = ["reason"] if name == "rejected" else [c for c in columns if c not in ("uid", "load_date_time")]
        uid = F.lit(None).cast("string").alias("uid") if name == "rejected" else F.col("uid")
        parts.append(rows.select(F.lit(name).alias("part"), uid, F.concat_ws("|", *[F.col(c).cast("string") for c in shown]).alias("detail")))
    return reduce(DataFrame.unionByName, parts)


FACT_SQL = f"""
  SELECT p.uid, 'a' || o_custkey AS account_id, c_name AS account_name, 'o' || c_nationkey AS account_owner_id,
         s2.s_name AS account_owner_name,
         CASE WHEN c_custkey % 4 = 0 OR c_custkey % 4 = 1 THEN c_acctbal ELSE 1.0 END AS final_amount,
         'o' || s1.s_suppkey AS rep_id, s1.s_name AS rep_name,
         'rep' || rep || '@example.com' AS participant_email, ['meeting', 'email', 'call'][kind + 1] AS request_type,
         CAST(CASE WHEN kind = 0 THEN o_orderkey % 7200 ELSE o_orderkey * i % 600 END AS BIGINT) AS actual_time_spent_in_sec
  FROM {PARTICIPANTS} p
  LEFT JOIN supplier s1 ON s1.s_suppkey = rep AND rep % 3 <> 0
  LEFT JOIN supplier s2 ON s2.s_suppkey = c_nationkey AND c_nationkey % 3 <> 0
  WHERE o_orderkey % 6 <> 0 AND (o_orderkey + i) % 2 = 0 AND o_orderdate >= TIMESTAMP '1997-08-01'
"""


@CATALOG.query("activity_fact", FACT_SQL)
def activity_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Internal participants with record, crm, account, rep and owner.

    Three of the five inputs come from the same records, so these are parsed
    once and staged.
    """
    good = through_storage(records(spark, folder), "records")
    customer = table(spark, folder, "customer")
    accounts = customer.select(
        F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("account_id"), F.col("c_name").alias("account_name"),
        F.concat(F.lit("o"), F.col("c_nationkey").cast("string")).alias("account_owner_id"),
        F.col("c_acctbal").alias("amount"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).when(F.col("c_custkey") % 4 == 1, 0.0).otherwise(1.0)
        .alias("amount_override"))
    users = table(spark, folder, "supplier").filter("s_suppkey % 3 <> 0").select(
        F.concat(F.lit("o"), F.col("s_suppkey").cast("string")).alias("user_id"), F.col("s_name").alias("user_name"),
        F.concat(F.lit("rep"), F.col("s_suppkey").cast("string"), F.lit("@example.com")).alias("username"))
    activities = activity.all_table(good, LOADED_AT).select(
        "uid", "request_type", "duration", F.to_timestamp("event_timestamp", ISO).alias("event_timestamp"))
    fact = activity.activity_fact(
        activities, activity.crm_table(good), activity.participant_table(good), accounts, users,
        activity.fiscal_cutoff(F.lit("1999-06-15").cast("date")))
    return fact.select(
        "uid", "account_id", "account_name", "account_owner_id", "account_owner_name", "final_amount", "rep_id",
        "rep_name", "participant_email", "request_type", "actual_time_spent_in_sec")


@CATALOG.query("activity_fact_shuffled", FACT_SQL)
def activity_fact_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same where no side is broadcast, as on large data."""
    return activity_fact(child_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}), folder)


@CATALOG.query("norm_mistyped", """
  SELECT 'u' || o_orderkey AS uid, o_orderpriority AS subject,
         CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS BIGINT) AS duration,
         'lead' AS matched_to, 'l' || o_orderkey AS crm_id, 'x@example.com' AS email, 'p' || o_custkey AS parent_account_crm_id
  FROM orders
""")
def norm_mistyped(spark: SparkSession, folder: str) -> DataFrame:
    """A field of another type is null and its record stays; every matched struct has all fields."""
    key = F.col("o_orderkey").cast("string")
    duration = F.when(F.col("o_orderkey") % 2 == 0, key).otherwise(F.concat(F.lit('"'), key, F.lit('.5 s"')))
    line = F.concat(
        F.lit('{"uid":"u'), key, F.lit('","subject":"'), F.col("o_orderpriority"), F.lit('","duration":'), duration,
        F.lit(',"crm_status":{"matched_to":"lead","lead":{"crm_id":"l'), key,
        F.lit('","email":"x@example.com","parent_account_crm_id":"p'), F.col("o_custkey").cast("string"), F.lit('"}}}'))
    good = activity.good_records(activity.parse_records(table(spark, folder, "orders").select(line.alias("value"))))
    return activity.by_uid(
        activity.all_table(good, LOADED_AT).select("uid", "subject", "duration"),
        activity.crm_table(good).select("uid", "matched_to", "crm_id", "email", "parent_account_crm_id"))


@CATALOG.query("cost_flatten", """
  SELECT CAST(m AS DATE) AS "startDate", CAST(m + INTERVAL 1 MONTH AS DATE) AS "endDate", 'acct' || l_suppkey AS account,
         'ship-' || l_returnflag AS service, s_name AS description, CAST(amount AS DOUBLE) AS amount, 'USD' AS currency,
         strftime(m, '%Y-%m-%d') || 'acct' || l_suppkey || 'ship-' || l_returnflag AS id
  FROM (SELECT date_trunc('month', l_shipdate) AS m, l_suppkey, l_returnflag,
               sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY 1, 2, 3) x
  JOIN supplier ON s_suppkey = l_suppkey
""")
def cost_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Report pages as landed JSON, flattened with descriptions and ids."""
    pages = cost_pages(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    parsed = codec.decode_json(pages, costs.REPORT_SCHEMA)
    return costs.with_cost_id(costs.flatten_costs(parsed))


@CATALOG.query("account_list", """
  SELECT 'acct' || s_suppkey AS "Id", s_name AS "Name",
         strftime(TIMESTAMP '2020-01-01 05:00:00' + to_days(CAST(s_suppkey AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS "JoinedTimestamp"
  FROM supplier
""")
def account_list(spark: SparkSession, folder: str) -> DataFrame:
    """Account pages, joined time with offset to UTC text."""
    joined = F.date_add(F.lit("2020-01-01").cast("date"), F.col("s_suppkey").cast("int"))
    pages = table(spark, folder, "supplier").select(F.array(F.struct(
        F.concat(F.lit("acct"), F.col("s_suppkey").cast("string")).alias("Id"), F.col("s_name").alias("Name"),
        F.concat(joined.cast("string"), F.lit("T00:00:00-05:00")).alias("JoinedTimestamp"))).alias("Accounts"))
    return costs.account_list(pages)


@CATALOG.query("array_explode", """
  SELECT 'user' || o_custkey AS actor, 'app' || i AS target, strftime(o_orderdate, '%Y-%m-%d') AS published_date,
         'user' || o_custkey || '~~' || strftime(o_orderdate, '%Y-%m-%d') AS id
  FROM (SELECT *, unnest(range(1, CAST(o_orderkey % 4 + 1 AS BIGINT))) AS i FROM orders)
  WHERE o_orderkey % 3 <> 0 AND i % 2 = 1
""")
def array_explode(spark: SparkSession, folder: str) -> DataFrame:
    """LATERAL VIEW explode with struct filters in a spec's SQL."""
    return through_spec(spark, "audit_targets", [file_input(folder, "orders")], """
      SELECT actor.id AS actor, t.id AS target, published_date, concat_ws('~~', actor.id, published_date) AS id
      FROM (
        SELECT named_struct('id', concat('user', o_custkey), 'type', IF(o_orderkey % 3 = 0, 'System', 'User')) AS actor,
               date_format(o_orderdate, 'yyyy-MM-dd') AS published_date,
               transform(filter(array(1, 2, 3), i -> i <= o_orderkey % 4), i ->
                 named_struct('id', concat('app', i), 'type', IF(i % 2 = 1, 'AppInstance', 'Group'))) AS target
        FROM orders) audit
      LATERAL VIEW explode(target) targets AS t
      WHERE actor.type = 'User' AND t.type = 'AppInstance'
    """)


def meetings(spark: SparkSession, folder: str) -> DataFrame:
    return codec.decode_json(meeting_messages(spark, folder), MEETING_SCHEMA)


@CATALOG.query("meeting_facts", """
  SELECT concat_ws('~~', CAST(user_id AS VARCHAR), CASE WHEN event_id % 17 <> 0 THEN 'm' || event_id END) AS meeting_id,
         started, round(CASE WHEN secs IS NULL THEN 0.0 ELSE secs / 60.0 END, 6) AS duration,
         CASE WHEN started OR planned = -1 THEN 'NA' WHEN planned >= secs / 60.0 THEN 'On-Time' ELSE 'Over-Time' END AS timeliness,
         CASE WHEN started OR planned = -1 THEN 'NA' WHEN secs / 60.0 < 10 THEN '<10 minutes'
              WHEN secs / 60.0 <= 30 THEN '10-30 minutes' WHEN secs / 60.0 <= 60 THEN '31-60 minutes'
              ELSE '60+ minutes' END AS breakdown
  FROM (SELECT *, event_id % 3 = 0 AS started,
               CASE WHEN event_id % 7 = 0 THEN -1 WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 60 END AS planned,
               CASE WHEN event_id % 3 = 1 AND event_id % 13 <> 0
                    THEN epoch(date_trunc('second', ts + to_minutes(event_id % 90) + to_seconds(event_id % 50)))
                         - epoch(date_trunc('second', ts)) END AS secs
        FROM events WHERE event_id % 3 < 2)
""")
def meeting_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Durations, timeliness and duration class, nulls included."""
    facts = meeting.meeting_facts(meetings(spark, folder))
    return facts.select(
        F.col("meetingUniqueId").alias("meeting_id"), (F.col("event") == "meeting.started").alias("started"),
        F.round("durationInMinutes", 6).alias("duration"), "timeliness", F.col("breakDownByDuration").alias("breakdown"))


@CATALOG.query("participant_facts", """
  SELECT CASE WHEN event_id % 2 = 0 THEN 'meeting.participant_joined' ELSE 'meeting.participant_left' END AS event,
         concat_ws('~~', CAST(user_id AS VARCHAR), CASE WHEN event_id % 17 <> 0 THEN 'm' || event_id END, 'p' || event_id % 23) AS id
  FROM events WHERE event_id % 3 = 2
""")
def participant_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Participant events with their composite id."""
    return meeting.participant_facts(meetings(spark, folder)).select("event", F.col("participantUniqueId").alias("id"))


@CATALOG.query("record_orders", """
  SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def record_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Q5: lookup join that salts the large side once the lookup is no longer small."""
    return orders_with_customer(spark, folder).select("o_orderkey", "c_name", "c_mktsegment")
