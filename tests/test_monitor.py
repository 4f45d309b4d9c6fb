from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from sluicework.operators import ledger, monitor

NOW = datetime(2024, 1, 2, 12)


def t(hour, minute=0, day=2):
    return datetime(2024, 1, day, hour, minute)


RUN = ("id string, name string, state string, finalStatus string, startedTime timestamp_ntz, launchTime timestamp_ntz,"
       " finishedTime timestamp_ntz, elapsedTime bigint")


def runs(spark, *items):
    return spark.createDataFrame([(i, n, s, f, a, a, b, 0) for i, n, s, f, a, b in items], RUN)


def test_scheduled_runs_and_status(spark):
    schedule = spark.createDataFrame([("p",), ("q",), ("never",)], "name string")
    r = runs(spark, ("1", "p", "FINISHED", "FAILED", t(1), t(2)), ("2", "p", "RUNNING", "UNDEFINED", t(3), None),
             ("3", "q", "RUNNING", "UNDEFINED", t(3), None), ("4", "q", "KILLED", "KILLED", t(4), t(5)), ("5", "x", "RUNNING", "UNDEFINED", t(9), None))
    joined = monitor.scheduled_runs(schedule, r)
    assert rows(joined, "name", "id") == sorted([("never", None), ("p", "1"), ("p", "2"), ("q", "3"), ("q", "4")], key=repr)
    assert monitor.PATTERNS in joined.columns
    status = monitor.latest_status(schedule, r)
    assert rows(status, "name", "id") == sorted([("never", None), ("p", "2"), ("q", "4")], key=repr)
    assert rows(monitor.not_running(status), "name") == [("never",), ("q",)]
    assert rows(monitor.latest_run(r, batch=True), "name", "id") == [("p", "1"), ("q", "4"), ("x", "5")]


def test_missed_windows(spark):
    schedule = spark.createDataFrame([("p", ["06:30", "11:30"]), ("q", ["06:30"])], "name string, scheduledAt array<string>")
    windows = monitor.schedule_windows(schedule, F.lit("2024-01-02").cast("date"))
    assert set(rows(windows)) == {("p", t(6, 30), t(7, 30)), ("p", t(11, 30), t(12, 30)), ("q", t(6, 30), t(7, 30))}
    inside = runs(spark, ("1", "p", "F", "S", t(6, 59), t(7, 30)))
    assert rows(monitor.missed_windows(windows, inside, NOW), "name") == [("q",)]
    second_hour = runs(spark, ("1", "p", "F", "S", t(7, 5), t(7, 20)), ("2", "q", "F", "S", t(6, 30), t(7, 31)))
    assert rows(monitor.missed_windows(windows, second_hour, NOW), "name") == [("q",)]
    early = runs(spark, ("1", "p", "F", "S", t(6, 29), t(7)), ("2", "q", "R", "U", t(6, 40), None))
    assert rows(monitor.missed_windows(windows, early, NOW), "name") == [("p",), ("q",)]
    late = datetime(2024, 1, 2, 12, 30)
    assert ("p", t(11, 30)) in rows(monitor.missed_windows(windows, inside, late), "name", "startTime")


def test_log_errors_newest_attempt(spark):
    status = spark.createDataFrame(
        [("a", "p", ["time.?out", "x<y"]), ("b", "q", ["timeout"]), ("c", "r", []), ("d", "s", None)],
        "id string, name string, errorLogPatterns array<string>")
    one = '<html><table id="layout"><tr><td></td><td><pre>{}</pre></td></tr></table></html>'
    pages = spark.createDataFrame([
        ("a", 1, one.format("fine")), ("a", 2, one.format("ok x&lt;y")), ("b", 1, one.format("timeout")), ("b", 2, one.format("fine<b>timeout</b>")),
        ("c", 1, one.format("timeout"))], "id string, attempt_id int, html string")
    assert rows(monitor.log_errors(status, pages)) == [("a", "p", True), ("b", "q", False)]


def test_incident_suppression_and_rows(spark):
    alerts = runs(spark, *[(str(i), n, "FINISHED", "FAILED", t(1), t(2)) for i, n in enumerate(("new", "old", "recent", "edge"))])
    incidents = spark.createDataFrame(
        [("old", t(10, 59)), ("old", t(1)), ("recent", t(11, 30)), ("recent", t(1, day=1)), ("edge", t(11))], "appName string, pdCreatedTime timestamp_ntz")
    raised = monitor.incidents_to_raise(alerts, incidents, NOW)
    assert rows(raised, "name") == [("new",), ("old",)]
    made = monitor.incident_rows(raised, "batch", NOW)
    again = monitor.incidents_to_raise(alerts, incidents.unionByName(made.select("appName", "pdCreatedTime")), NOW)
    assert again.isEmpty()


def test_raise_incidents_replays_and_suppresses(spark, tmp_path):
    alerts = runs(spark, ("1", "p", "FINISHED", "FAILED", t(1), t(2)), ("2", "q", "KILLED", "KILLED", t(1), t(2)))
    path = str(tmp_path / "incidents")
    for key in ("c1", "c1"):
        assert rows(monitor.raise_incidents(alerts, path, "batch", key, NOW), "appName") == [("p",), ("q",)]
    assert monitor.raise_incidents(alerts, path, "batch", "c2", t(12, 30)).isEmpty()
    assert rows(monitor.raise_incidents(alerts.filter("name = 'p'"), path, "batch", "c3", t(13, 1)), "appName", "appState") == [("p", "FINISHED")]
    assert spark.read.parquet(path).count() == 3


def test_ledger(spark):
    files = spark.createDataFrame([("m-1-2024-01-01.csv",), ("m-1-2024-01-01.csv",), ("m-2.csv.done",), ("m-3.txt",), ("z.csv",)], "file_name string")
    kept = ledger.accepted(files, ["m-"])
    entries = ledger.ledger_entries(ledger.new_files(kept, spark.createDataFrame([], ledger.LEDGER_SCHEMA)))
    assert rows(entries.select("file_name", F.col("extract_date").cast("string"))) == sorted(
        [("m-1-2024-01-01.csv", "2024-01-01"), ("m-2.csv.done", None)], key=repr)
    assert ledger.new_files(kept, entries).isEmpty()
    pushed = spark.createDataFrame([("m-2.csv.done", NOW)], "file_name string, pushed_at timestamp")
    assert rows(ledger.unpushed(ledger.mark_pushed(entries, pushed)), "file_name") == [("m-1-2024-01-01.csv",)]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    from sluicework.operators import ledger
    from sluicework.sources.files import with_file_columns

    for name, size in (("a", 900), ("b", 1), ("c", 400)):
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{name}{i}\n" for i in range(size)))
    with_small = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in with_small}
    try:
        for key, value in with_small.items():
            spark.conf.set(key, value)
        lines = with_file_columns(spark.read.option("header", True).schema("v string").csv(str(tmp_path)))
        assert lines.select("file_name", "_row_start").distinct().count() > 6
        found = {(r.file_name[0], r.line_number): r.v for r in ledger.numbered_lines(lines).collect()}
        first = sorted(r.v for r in ledger.first_rows(lines).collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found == {(name, i): f"{name}{i}" for name, size in (("a", 900), ("b", 1), ("c", 400)) for i in range(size)}
    assert first == ["a0", "b0", "c0"]
