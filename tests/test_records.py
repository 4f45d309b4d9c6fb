import json
from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import explained, rows
from sluicework.catalog.core import spec_document
from sluicework.catalog.records import CATALOG
from sluicework.operators import activity, costs, enrich, meeting
from sluicework.plans.runner import run_pipeline
from sluicework.plans.spec import load_pipeline

FULL = {
    "uid": "u1", "type": "meeting", "tags": ["a", "b"], "attachment_file_names": [], "duration": 60,
    "timestamp": "2024-01-01T00:00:00Z",
    "campaigns": [{"crm_id": "c1", "name": "C"}],
    "participants": [{"email": "x@example.com", "type": "internal", "time_spent": 5, "team": {"name": "T"}}, {"email": "y@example.com"}],
    "stats": {"total_participants": 2},
    "crm_status": {"matched_to": "lead", "crm_id": "t", "account": {"crm_id": "a", "name": "A"},
                   "lead": {"crm_id": "l", "email": "l@example.com", "name": "L"}},
}


def records(spark, *items):
    lines = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
    return activity.parse_records(spark.createDataFrame(lines, "value string"))


def test_normalise(spark):
    parsed = records(spark, FULL, "{bad", {"type": "email"}, {"uid": "u2"})
    good = activity.good_records(parsed)
    tables = activity.normalise(good, datetime(2024, 1, 2))
    assert rows(tables["all"], "uid", "request_type", "tags", "attachment_file_names") == [
        ("u1", "meeting", "a,b", None), ("u2", None, None, None)]
    assert rows(tables["campaign"]) == [("u1", "c1", "C", None, None)]
    assert rows(tables["participant"], "uid", "email", "team") == sorted([
        ("u1", "x@example.com", "T"), ("u1", "y@example.com", None)], key=repr)
    assert rows(tables["activity"], "uid", "total_participants") == [("u1", 2), ("u2", None)]
    assert rows(tables["crm"], "uid", "task_id", "acc_crm_id", "crm_id", "name", "email", "stage_name") == [
        ("u1", "t", "a", "l", "L", "l@example.com", None), ("u2", None, None, None, None, None, None)]
    assert rows(activity.rejected_records(parsed), "reason") == [("malformed",), ("no_uid",)]


def test_matched_pick_kinds(spark):
    def record(kind):
        return {"uid": kind, "crm_status": {**FULL["crm_status"], "matched_to": kind, "opportunity": {
            "crm_id": "o", "name": "O", "stage_name": "s", "stage_rank": 3}}}
    crm = activity.crm_table(activity.good_records(records(spark, *map(record, ("none", "account", "opportunity", "other")))))
    assert rows(crm, "uid", "crm_id", "stage_rank") == [
        ("account", "a", None), ("none", None, None), ("opportunity", "o", 3), ("other", None, None)]


def test_override_and_cutoff(spark):
    df = spark.createDataFrame([(None, 5.0), (0.0, 5.0), (7.0, 5.0)], "o double, d double")
    assert [r[0] for r in df.select(activity.override_or_default("o", "d")).collect()] == [5.0, 5.0, 7.0]
    days = spark.createDataFrame([(date(2024, 7, 31),), (date(2024, 8, 1),), (date(2024, 1, 1),)], "d date")
    assert [r[0] for r in days.select(activity.fiscal_cutoff(F.col("d"))).collect()] == [
        date(2022, 8, 1), date(2023, 8, 1), date(2022, 8, 1)]


def test_costs_last_description_wins(spark):
    page = {"DimensionValueAttributes": [
        {"Value": "1", "Attributes": {"description": "old"}}, {"Value": "1", "Attributes": {"description": "new"}}, {"Value": "2"}],
        "ResultsByTime": [{"TimePeriod": {"Start": "2024-01-01", "End": "2024-01-02"}, "Groups": [
            {"Keys": ["1", "EC"], "Metrics": {"AmortizedCost": {"Amount": "1.5", "Unit": "USD"}}},
            {"Keys": ["2", "S"], "Metrics": {"AmortizedCost": {"Amount": "2", "Unit": "USD"}}}]}]}
    df = spark.createDataFrame([(json.dumps(page),)], "v string").select(F.from_json("v", costs.REPORT_SCHEMA).alias("p")).select("p.*")
    assert rows(costs.with_cost_id(costs.flatten_costs(df)), "id", "description", "amount") == sorted([
        ("2024-01-011EC", "new", 1.5), ("2024-01-012S", None, 2.0)], key=repr)


def meeting_event(event, start, end, duration):
    return json.dumps({"event": event, "payload": {"object": {
        "id": "1", "uuid": "u", "duration": duration, "start_time": start, "end_time": end}}})


def test_meeting_edges(spark):
    from sluicework.catalog.fixtures import MEETING_SCHEMA

    s = "2024-01-01T10:00:00Z"
    lines = [
        meeting_event("meeting.started", s, None, 30),
        meeting_event("meeting.ended", s, "2024-01-01T10:09:59Z", 30),
        meeting_event("meeting.ended", s, "2024-01-01T10:10:00Z", 10),
        meeting_event("meeting.ended", s, "2024-01-01T10:30:01Z", 30),
        meeting_event("meeting.ended", s, None, 30),
        meeting_event("meeting.ended", s, "2024-01-01T12:00:00Z", -1),
        meeting_event("meeting.ended", s, "2024-01-01T11:00:00Z", None),
        meeting_event("other", s, None, 1),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "v string").select(F.from_json("v", MEETING_SCHEMA).alias("m")).select("m.*")
    out = [tuple(r) for r in meeting.meeting_facts(df).select("timeliness", "breakDownByDuration", F.round("durationInMinutes", 2)).collect()]
    assert out == [("NA", "NA", 0.0), ("On-Time", "<10 minutes", 9.98), ("On-Time", "10-30 minutes", 10.0),
                   ("Over-Time", "31-60 minutes", 30.02), ("Over-Time", "60+ minutes", 0.0), ("NA", "NA", 120.0),
                   ("Over-Time", "31-60 minutes", 60.0)]


def test_enrich_routes(spark):
    requests = spark.createDataFrame([("m1", "s", 0), ("m2", "s", 3), ("m3", "s", 4)], "meeting_id string, start_time string, attempt int")
    lookup = spark.createDataFrame([("m1", "d1"), ("m1", None)], "meetingId string, device string")
    counted = enrich.child_counts(requests, lookup, "meeting_id", "meetingId")
    assert rows(enrich.count_messages(counted, "meeting_id", "start_time")) == [("m1_count", "m1~~s~~2")]
    routed = enrich.route_attempts(counted)
    assert rows(routed, "meeting_id", "route", "next_attempt") == [("m1", "done", 0), ("m2", "retry", 4), ("m3", "give_up", 5)]
    now = datetime(2024, 1, 1)
    failed = enrich.failure_messages(routed, "meeting_id", "start_time", now)
    assert rows(failed) == [("m2_fail", "m2~~s~~1704067200000~~4")]
    unpacked = enrich.unpack_failures(failed)
    assert unpacked.first()["attempt"] == 4
    later, early = datetime(2024, 1, 1, 0, 2, 1), datetime(2024, 1, 1, 0, 2)
    assert enrich.split_due(unpacked, now=later)[0].count() == 1
    assert enrich.split_due(unpacked, now=early)[1].count() == 1


def test_fetcher_retries_then_counts_as_failed(spark):
    requests = spark.createDataFrame([("ok",), ("down",)], "meeting_id string")

    def fetch(identifier):
        if identifier == "down":
            raise OSError("no answer")
        return [{"device": "pc", "unknown": 1}]

    fetched = enrich.enrich_with_fetcher(requests, "meeting_id", fetch)
    sizes = {r["meeting_id"]: None if r["children"] is None else len(r["children"]) for r in fetched.collect()}
    assert sizes == {"ok": 1, "down": None}
    child = enrich.flatten_children(fetched, "children", "meeting_id").first()
    assert child["device"] == "pc" and child["location"] == "" and child["meetingId"] == "ok"


def test_one_pass_gives_the_tables_of_five(spark):
    lines = [
        '{"uid":"a","type":"call","tags":["x","y"],"campaigns":[{"crm_id":"c1"},{"crm_id":"c2"}],"stats":{"total_participants":3},'
        '"participants":[{"name":"P","team":{"name":"T"}}],"crm_status":{"matched_to":"lead","lead":{"crm_id":"l"}}}',
        '{"uid":"b","duration":"long","campaigns":null}', "{}", "no json", None, '{"uid":"d"} trailing', '{"uid":"e"}{"uid":"f"}', "",
        '{"uid":"g"']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    tagged = activity.tagged_rows(frame, loaded_at=datetime(2024, 1, 2))
    good = activity.good_records(activity.parse_records(frame))
    for name, table in activity.normalise(good, datetime(2024, 1, 2)).items():
        assert activity.one_table(tagged, name).dtypes == table.dtypes
        assert rows(activity.one_table(tagged, name)) == rows(table)
    assert sorted(r.uid for r in good.collect()) == ["a", "b"]
    rejected = sorted((r.reason, r.line or "") for r in activity.one_table(tagged, "rejected").collect())
    assert rejected == sorted([("no_uid", ""), ("no_uid", ""), ("malformed", "no json"), ("malformed", '{"uid":"d"} trailing'),
                               ("malformed", '{"uid":"e"}{"uid":"f"}'), ("malformed", ""), ("malformed", '{"uid":"g"')])
    plan = explained(tagged)
    # One node parses; the tree and the details below it name it once each.
    assert plan.count("from_json") <= 2 and plan.count("Exchange") == 0


def test_a_spec_writes_each_table_with_its_own_columns(spark, tmp_path):
    lines = [
        '{"uid":"a","type":"call","tags":["x","y"],"campaigns":[{"crm_id":"c1"},null],"participants":[{"name":"P","team":{"name":"T"}}]}',
        '{"uid":"a","stats":{"total_participants":3},"crm_status":{"matched_to":"lead","lead":{"crm_id":"l"}}}', "{}", "no json"]
    (tmp_path / "lines").write_text("\n".join(lines))
    document = spec_document(
        "tables", [{"format": "file", "file_format": "text", "path": f"{tmp_path}/lines", "alias": "lines"}], "select value from lines",
        [{"query": "select * from #process", "action": "file", "format": "parquet", "output_location": f"{tmp_path}/{name}",
          "custom_postprocess_code_snippet": f"activity.{name}"} for name in activity.TABLES],
        custom_process_code_snippet="activity.records")
    run_pipeline(spark, load_pipeline(document, "tables"), {"share_output": "stage"})
    parsed = activity.parse_records(spark.createDataFrame([(line,) for line in lines], "value string"))
    for name, columns in activity.TABLES.items():
        found, wanted = spark.read.parquet(f"{tmp_path}/{name}"), activity.table_of(parsed, name)
        assert tuple(found.columns) == columns and found.dtypes == wanted.dtypes
        assert rows(found.drop("load_date_time")) == rows(wanted.drop("load_date_time"))
    assert rows(spark.read.parquet(f"{tmp_path}/campaign"), "uid", "crm_id") == [("a", "c1"), ("a", None)]


def test_activity_tables_are_narrow_and_may_be_empty(spark, tmp_path):
    customers = spark.createDataFrame([(7, "C", "M", 1, 2.0)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey long, c_acctbal double")
    orders = spark.createDataFrame(
        [(3, 7, "O", 1.0, datetime(1997, 1, 2), "LOW"), (3, 7, "O", 1.0, datetime(1997, 1, 2), "LOW"), (103, 7, "O", 1.0, None, None),
         (101, 7, "O", 1.0, None, None), (None, 7, "O", 1.0, None, None), (5, 8, "O", 1.0, None, None)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    for folder, kept in (("some", orders), ("none", orders.limit(0))):
        customers.write.parquet(f"{tmp_path}/{folder}/customer.parquet")
        kept.write.parquet(f"{tmp_path}/{folder}/orders.parquet")
    found = CATALOG.queries["activity_tables"](spark, f"{tmp_path}/some")
    # No rows that are as wide as all tables and dealt out by their name.
    assert not any("table=" in name for name in found.inputFiles())
    assert rows(found.groupBy("part").count()) == [
        ("activity", 2), ("all", 2), ("crm", 2), ("participant", 6), ("rejected", 3)]
    assert rows(found.filter("part = 'rejected'"), "detail") == [("malformed",), ("no_uid",), ("no_uid",)]
    assert CATALOG.queries["activity_tables"](spark, f"{tmp_path}/none").count() == 0


def test_tables_of_records_are_joined_without_sending_one_whole(spark, tmp_path):
    # Few rows, which Spark would broadcast by their size alone; a repeated and a null key keep their meaning.
    spark.createDataFrame([(1, 7, "HIGH"), (2, 8, "LOW"), (2, 9, "LOW"), (None, 5, "LOW")],
                          "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    found = CATALOG.queries["norm_mistyped"](spark, str(tmp_path))
    assert "Broadcast" not in explained(found)
    assert rows(found, "uid", "duration", "parent_account_crm_id") == [
        ("u1", None, "p7"), ("u2", 2, "p8"), ("u2", 2, "p8"), ("u2", 2, "p9"), ("u2", 2, "p9")]
