import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sluicework.catalog.core import file_input, spec_document, stream_input
from sluicework.operators import ledger
from sluicework.plans import runlog
from sluicework.plans.hooks import hook
from sluicework.plans.runner import PipelinesFailed, run_batch, run_pipeline
from sluicework.plans.spec import load_pipeline
from sluicework.session import shared_dir
from sluicework.streaming.ranges import TimeRangesReader
from sluicework.streaming.runner import drain, start_pipeline


def out(path, query="select * from #process", **extra):
    return {"query": query, "action": "file", "format": "parquet", "output_location": path, **extra}


@hook("tests.failing")
def failing(df):
    raise RuntimeError("hook broke\nsecond line")


def test_run_batch_logs_and_tries_all(spark, sf, tmp_path):
    target, log = str(tmp_path / "out"), str(tmp_path / "log")
    good = spec_document("Good", [file_input(sf, "nation")], "select n_regionkey, count(*) c from nation group by 1", [out(target)])
    bad = spec_document("Bad", [file_input(sf, "nation", custom_preprocess_code_snippet="tests.failing")], "select * from nation", [out(target)])
    config = {"process": {**bad["process"], **good["process"]}}
    enable = {"process": {"actions": {"Bad": {"isEnabled": "true"}, "Good": {"isEnabled": "true"}, "Off": {"isEnabled": "no"}}}}
    with pytest.raises(PipelinesFailed, match="Bad: RuntimeError: hook broke$"):
        run_batch(spark, config, enable, log_path=log)
    assert spark.read.parquet(target).agg(F.sum("c")).first()[0] == 25
    seen = rows(runlog.read(spark, log), "dataset_id", "status")
    assert seen == [("Bad", "Failed"), ("Bad", "Started"), ("Good", "Finished"), ("Good", "Started")]
    failed = runlog.read(spark, log).filter("status = 'Failed'").first()
    assert failed["error_message"].startswith("hook broke") and "RuntimeError" in failed["stack_trace"]


@hook("tests.upper")
def upper(df):
    return df.selectExpr("upper(r_name) AS name")


def test_pipeline_hook_snippet_beats_file(spark, sf):
    doc = spec_document("Hooked", [file_input(sf, "region")], "select lower(r_name) as r_name from region",
                        [{"query": "select * from #process", "action": "noop"}],
                        custom_process_code_snippet="tests.upper", custom_process_file="tests.failing")
    frame = run_pipeline(spark, load_pipeline(doc, "Hooked"), write=False).frame
    assert frame.columns == ["name"] and rows(frame)[0] == ("AFRICA",)


def test_outputs_have_hooks_of_their_own(spark, sf, tmp_path):
    doc = spec_document("Outputs", [file_input(sf, "region")], "select lower(r_name) as r_name from region", [
        out(f"{tmp_path}/upper", custom_postprocess_code_snippet="tests.upper"), out(f"{tmp_path}/plain")])
    run_pipeline(spark, load_pipeline(doc, "Outputs"), {"share_output": "stage"})
    assert rows(spark.read.parquet(f"{tmp_path}/upper"), "name")[0] == ("AFRICA",)
    assert rows(spark.read.parquet(f"{tmp_path}/plain"), "r_name")[0] == ("africa",)


def test_bare_window_counts_seconds():
    from sluicework.streaming.runner import _trigger

    class Writer:
        def trigger(self, **options):
            return options

    assert _trigger(Writer(), {"window": "5"}) == {"processingTime": "5 seconds"}
    assert _trigger(Writer(), {"window": "2 minutes"}) == {"processingTime": "2 minutes"}
    assert _trigger(Writer(), {"trigger": "available_now", "window": "5"}) == {"availableNow": True}


def test_without_commits_a_restart_begins_anew(spark, tmp_path):
    source, target = str(tmp_path / "src"), str(tmp_path / "out")
    spark.range(3).write.json(source)
    events = {"format": "file", "file_format": "json", "path": source, "schema_ddl": "id INT", "alias": "e"}
    for commit in ("false", "false", "true", "true"):
        doc = spec_document("S", [{**events, "commit_offset": commit}], "select id from e", [out(target)], "real")
        start_pipeline(spark, load_pipeline(doc, "S"), {"checkpoint_dir": str(tmp_path / "ck"), "trigger": "available_now"}).awaitTermination()
    assert spark.read.parquet(target).count() == 9


def test_scratch_is_removed_after_a_run(spark, sf, tmp_path):
    from sluicework.session import path_exists, scratch_scope

    with scratch_scope(spark) as opened:
        inner = shared_dir(spark, "x")
        spark.range(1).write.parquet(inner)
    assert opened == [inner] and not path_exists(spark, inner)
    changes = {"format": "changes", "path": f"{sf}/events.parquet", "ts_col": "ts", "buffer_size": "200", "alias": "c"}
    doc = spec_document("Bulk", [changes], "select * from c", [out(str(tmp_path / "o"))])
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in root.iterdir()}
    run_pipeline(spark, load_pipeline(doc, "Bulk"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == spark.read.parquet(f"{sf}/events.parquet").count()
    left = {p.name for p in root.iterdir()} - before
    assert not [name for name in left if name.startswith(("buckets-", "bucket-marks-"))]


def test_views_do_not_leak_between_pipelines(spark, sf):
    spec = load_pipeline(spec_document("Leak", [file_input(sf, "region", "same")], "select * from same", [{"query": "select * from #process", "action": "noop"}]), "Leak")
    run = run_pipeline(spark, spec)
    assert run.session.catalog.tableExists("same") and not spark.catalog.tableExists("same")


@pytest.mark.parametrize("share", ["persist", "stage", "none"])
def test_outputs_share_the_pipeline_frame(spark, sf, tmp_path, share):
    doc = spec_document("Two", [file_input(sf, "nation")], "select * from nation", [
        out(str(tmp_path / "a")), out(str(tmp_path / "b"), "select n_name from #process where n_regionkey = #key")])
    run_pipeline(spark, load_pipeline(doc, "Two"), {"share_output": share}, {"key": "1"})
    assert spark.read.parquet(str(tmp_path / "a")).count() == 25
    assert spark.read.parquet(str(tmp_path / "b")).columns == ["n_name"]


def test_lenient_sql_per_spec(spark, sf):
    doc = spec_document("Lenient", [file_input(sf, "region")], "select array(1)[5] as v, cast('x' as int) as w from region limit 1",
                        [{"query": "select * from #process", "action": "noop"}], sql_conf={"spark.sql.ansi.enabled": "false"})
    assert run_pipeline(spark, load_pipeline(doc, "Lenient"), write=False).frame.first()[:] == (None, None)


def test_kafka_commits_what_was_read(spark, tmp_path):
    topic, commits, target = str(tmp_path / "topic"), str(tmp_path / "commits"), str(tmp_path / "out")
    shape = "CAST('k' AS BINARY) AS key, CAST(to_json(named_struct('id', id)) AS BINARY) AS value, 't' AS topic, CAST(id % 2 AS INT) AS partition, id div 2 AS offset"
    spark.sql(f"SELECT {shape} FROM range(0, 10)").write.parquet(topic)
    source = {"format": "kafka", "topic": "t", "group_id": "g", "replay_path": topic, "commit_table": commits,
              "data_format": "json", "schema_ddl": "id BIGINT", "alias": "m"}
    spec = load_pipeline(spec_document("Read", [source], "select * from m", [out(target)]), "Read")
    run_pipeline(spark, spec)
    spark.sql(f"SELECT {shape} FROM range(10, 15)").write.mode("append").parquet(topic)
    run_pipeline(spark, spec)
    run_pipeline(spark, spec)
    assert [r[0] for r in rows(spark.read.parquet(target))] == sorted(range(15), key=lambda v: repr((v,)))
    held = load_pipeline(spec_document("Read", [{**source, "group_id": "h", "commit": "false"}], "select * from m", [out(target, mode="overwrite")]), "Read")
    run_pipeline(spark, held)
    run_pipeline(spark, held)
    assert spark.read.parquet(target).count() == 15


def test_participant_sink(spark, tmp_path):
    target = str(tmp_path / "topics")
    requests = spark.createDataFrame([("2", "s", 0), ("0", "s", 1), ("0", "z", 9)], "meeting_id string, start_time string, attempt int")
    requests.write.parquet(str(tmp_path / "req"))
    sink = {"query": "select * from #process", "action_class": "x.WriteZoomParticipantDevice", "topic": "meta", "replay_path": target}
    spark.createDataFrame([("2", "pc"), ("2", None)], "meetingId string, device string").write.parquet(str(tmp_path / "lookup"))
    doc = spec_document("P", [{"format": "file", "file_format": "parquet", "path": str(tmp_path / "req"), "alias": "r"}],
                        "select * from r", [{**sink, "lookup_path": str(tmp_path / "lookup")}])
    run_pipeline(spark, load_pipeline(doc, "P"))
    topics = spark.read.parquet(target)
    assert {(r["topic"], r["key"]) for r in topics.collect()} == {
        ("meta", "device"), ("meta", "2_count"), ("meta_fail", "0_fail"), ("meta_give_up", "0_give_up")}
    assert topics.filter("key = 'device'").count() == 2
    assert json.loads(topics.filter("value LIKE '%pc%'").first()["value"])["meetingId"] == "2"


def test_participant_sink_with_fetcher(spark, tmp_path):
    from sluicework.plans.hooks import HOOKS
    from sluicework.sinks.participants import enriched_results

    HOOKS.register("tests.lookup")(lambda identifier: [{"device": f"d{identifier}"}] * int(identifier))
    requests = spark.createDataFrame([("2", "s"), ("0", "s")], "meeting_id string, start_time string")
    topic, failed, given_up = enriched_results(requests, {"fetcher": "tests.lookup", "_stage_path": str(tmp_path / "f")})
    assert rows(topic, "key") == [("2_count",), ("device",), ("device",)]
    assert [v.split("~~")[3] for v, in rows(failed, "value")] == ["1"]
    assert given_up.count() == 0


def test_time_ranges_reader_replays():
    reader = TimeRangesReader({"start": "2024-01-01T00:00:00", "cap": "2", "unit": "days", "until": "2024-01-04T12:00:00"})
    offset, seen = reader.initialOffset(), []
    while True:
        found, end = reader.read(offset)
        found = list(found)
        if not found:
            assert end == offset
            break
        assert list(reader.readBetweenOffsets(offset, end)) == found
        seen += found
        offset = end
    assert seen == [("2024-01-01T00:00:00", "2024-01-03T00:00:00"), ("2024-01-03T00:00:00", "2024-01-04T12:00:00")]


def test_range_stream_resumes_from_its_checkpoint(spark, tmp_path):
    source, target = str(tmp_path / "src"), str(tmp_path / "out")
    spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS ts FROM range(10)").write.parquet(source)

    def run(until):
        changes = {"format": "sfdc", "path": source, "offset_column": "ts", "max_offset_days_per_trigger": "2", "until": until, "alias": "c"}
        doc = spec_document("C", [changes], "select id from c", [out(target, idempotent="true")], "real")
        drain(start_pipeline(spark, load_pipeline(doc, "C"), {"checkpoint_dir": str(tmp_path / "ck")}))

    run("2024-01-05T00:00:00Z")
    assert [r[0] for r in rows(spark.read.parquet(target), "id")] == [0, 1, 2, 3]
    run("2024-01-20T00:00:00Z")
    assert [r[0] for r in rows(spark.read.parquet(target), "id")] == list(range(10))


def test_file_stream_restart_adds_only_new_files(spark, tmp_path):
    source, target = str(tmp_path / "src"), str(tmp_path / "out")

    def run():
        events = {"format": "file", "file_format": "json", "path": source, "schema_ddl": "id INT", "alias": "e", "max_files_per_trigger": "1"}
        doc = spec_document("S", [events], "select id from e", [out(target, idempotent="true"), out(target + "2", "select id * 2 as id from #process")], "BasicReal")
        start_pipeline(spark, load_pipeline(doc, "S"), {"checkpoint_dir": str(tmp_path / "ck"), "trigger": "available_now"}).awaitTermination()

    spark.range(0, 4).write.json(source)
    run()
    run()
    spark.range(4, 6).write.mode("append").json(source)
    run()
    assert [r[0] for r in rows(spark.read.parquet(target), "id")] == list(range(6))
    assert spark.read.parquet(target + "2").count() == 6


def test_static_side_is_read_again(spark, sf, tmp_path):
    static, target = str(tmp_path / "static"), str(tmp_path / "out")
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(static)
    events = stream_input(spark, sf, "region", "r")
    doc = spec_document("J", [events, {"format": "file", "file_format": "parquet", "path": static, "alias": "s"}],
                        "select r_name, v from r join s on r_regionkey = k", [out(target)], "BasicStreamingReal")
    spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string").write.mode("overwrite").parquet(static)
    start_pipeline(spark, load_pipeline(doc, "J"), {"trigger": "available_now", "commit_offset": "false"}).awaitTermination()
    assert rows(spark.read.parquet(target)) == [("AMERICA", "new"), ("ASIA", "new")]


def test_ingest_replay_keeps_messages(spark, tmp_path):
    batch = spark.createDataFrame([("m-1.csv", 0, "x"), ("z.csv", 0, "y")], "file_name string, _row_start int, Name string")
    book, messages = str(tmp_path / "book"), str(tmp_path / "msg")
    for key in ("0-a", "0-a", "1-a", "0-b"):
        ledger.ingest_batch(batch, {"Name": "n"}, ["m-"], book, messages, key)
    assert rows(spark.read.parquet(messages), "value") == [('{"n":"x"}',)]
    assert ledger.read_ledger(spark, book).count() == 1


def test_shared_dir_uses_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root) and shared_dir(spark, "x") != shared_dir(spark, "x")


def test_a_stream_needs_a_checkpoint(spark, sf):
    doc = spec_document("Q", [{"format": "file", "file_format": "parquet", "path": sf, "path_glob": "events.parquet",
                               "sample_path": f"{sf}/events.parquet", "alias": "e"}], "select * from e",
                        [{"query": "select * from #process", "action": "noop"}], kind="real")
    with pytest.raises(ValueError, match="checkpoint_dir"):
        start_pipeline(spark, load_pipeline(doc, "Q"), {"trigger": "available_now"})


def test_the_shared_folder_needs_no_setting_on_one_machine(spark):
    class Conf:
        values = {"spark.sql.warehouse.dir": "/w"}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "local[2]"})

    from sluicework.session import shared_root

    assert shared_root(Session()) == "/w/_shared"
    Session.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="sluicework.shared.dir"):
        shared_root(Session())
    Conf.values["sluicework.shared.dir"] = "hdfs://x/"
    assert shared_root(Session()) == "hdfs://x"


def test_a_late_start_reads_from_the_earliest_row_once(spark, tmp_path):
    from datetime import datetime, timedelta

    from sluicework.streaming.latestart import LateStart, tiles

    day, unit = datetime(2024, 1, 10), timedelta(days=1)
    late = LateStart(spark, str(tmp_path), True)
    ask = lambda number, lowest: late.bounds(number, day, day + unit, 7, unit, lambda end: lowest)
    assert ask(0, None) == []
    assert ask(1, day - 10 * unit) == [(day - 10 * unit, day - 3 * unit), (day - 3 * unit, day + unit)]
    # A repeat of that batch reads the same; batches after it read their own range; a restart keeps the state.
    late = LateStart(spark, str(tmp_path), False)
    assert len(ask(1, day - 10 * unit)) == 2
    assert ask(2, day - 20 * unit) == [(day, day + unit)]
    assert LateStart(spark, str(tmp_path / "other"), False).bounds(0, day, day + unit, 7, unit, lambda end: None) == [(day, day + unit)]
    assert tiles(day, day, 7, unit) == []


def test_tasks_of_an_ingest_do_not_grow_with_the_splits(spark, tmp_path):
    messages, book = str(tmp_path / "messages"), str(tmp_path / "book")
    batch = spark.range(0, 1200, 1, 300).selectExpr(
        "CAST(id AS STRING) AS Name", "concat('m-', id % 3, '.csv') AS file_name", "id AS _row_start")
    ledger.ingest_batch(batch, {"Name": "n"}, ["m-"], book, messages, "0-q")
    found = spark.read.parquet(messages)
    assert found.count() == 1200
    assert len(found.inputFiles()) <= 8 * spark.sparkContext.defaultParallelism
    first = str(tmp_path / "first")
    ledger.ingest_batch(batch, {"Name": "n"}, ["m-"], str(tmp_path / "book2"), first, "0-q", first_row_only=True)
    assert rows(spark.read.parquet(first), "value") == [('{"n":"0"}',), ('{"n":"1"}',), ('{"n":"2"}',)]
