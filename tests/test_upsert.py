from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import explained, rows
from sluicework.operators import snapshots, upsert
from sluicework.session import delete_path, path_exists, shared_dir
from sluicework.sinks import core, files, rdb


def table(spark, data):
    return spark.createDataFrame(data, "id string, v int, seq int")


def test_twice_is_once(spark):
    target = shared_dir(spark, "t")
    first = table(spark, [("a", 1, 1), ("b", 1, 1), ("a", 2, 2)])
    snapshots.upsert(first, target, ["id"], "seq", 4)
    snapshots.upsert(table(spark, [("b", 5, 3), ("c", 6, 3)]), target, ["id"], "seq", 4)
    want = [("a", 2, 2), ("b", 5, 3), ("c", 6, 3)]
    assert rows(snapshots.read_keyed(spark, target), "id", "v", "seq") == want
    snapshots.upsert(table(spark, [("b", 5, 3), ("c", 6, 3)]), target, ["id"], "seq", 4)
    snapshots.upsert(first, target, ["id"], "seq", 4)
    assert rows(snapshots.read_keyed(spark, target), "id", "v", "seq") == want


def test_batch_wins_without_order(spark):
    target = shared_dir(spark, "t")
    snapshots.upsert(table(spark, [("a", 9, 9)]), target, ["id"])
    snapshots.upsert(table(spark, [("a", 1, 1)]), target, ["id"])
    assert rows(snapshots.read_keyed(spark, target), "id", "v", "seq") == [("a", 1, 1)]


def data_files(spark, target):
    return {r[0] for r in spark.read.option("basePath", f"{target}/data").parquet(f"{target}/data/*").select(
        "_metadata.file_path").distinct().collect()}


def test_a_small_batch_writes_no_old_row(spark):
    target = shared_dir(spark, "t")
    many = spark.range(200).selectExpr("CAST(id AS STRING) AS id", "1 AS v", "1 AS seq")
    snapshots.upsert(many, target, ["id"], "seq", 8)
    before = data_files(spark, target)
    snapshots.upsert(many.limit(1).withColumn("v", F.lit(2)).withColumn("seq", F.lit(2)), target, ["id"], "seq", 64)
    new = data_files(spark, target) - before
    assert before <= data_files(spark, target) and sum(spark.read.parquet(f).count() for f in new) == 1
    assert snapshots.manifest(spark, target)["buckets"] == 8
    assert snapshots.read_keyed(spark, target).count() == 200
    snapshots.compact(spark, target)
    told = snapshots.manifest(spark, target)
    assert told["deltas"] == [] and sorted(map(int, told["base"])) == list(range(8))
    # A delta after that touches one bucket, and compaction rewrites that bucket alone.
    snapshots.upsert(many.limit(1), target, ["id"], "seq")
    old = told["base"]
    snapshots.compact(spark, target)
    now = snapshots.manifest(spark, target)["base"]
    assert sum(now[b] != old[b] for b in now) == 1
    assert snapshots.read_keyed(spark, target).where("v = 2").count() == 1


def test_a_reader_keeps_its_version(spark):
    target = shared_dir(spark, "t")
    snapshots.upsert(table(spark, [("a", 1, 1), (None, 1, 1)]), target, ["id"])
    old = snapshots.read_keyed(spark, target)
    snapshots.upsert(table(spark, [("a", 2, 2), (None, 3, 3), ("b", 2, 2)]), target, ["id"])
    snapshots.compact(spark, target)
    assert rows(old, "id", "v") == [("a", 1), (None, 1)]
    assert rows(snapshots.read_keyed(spark, target), "id", "v") == [("a", 2), ("b", 2), (None, 3)]
    assert rows(snapshots.read_keyed(spark, target, 1), "id", "v") == [("a", 1), (None, 1)]
    with pytest.raises(LookupError):
        snapshots.read_keyed(spark, target, 9)


def test_a_failed_commit_changes_nothing_and_a_lost_race_is_run_again(spark, monkeypatch):
    target = shared_dir(spark, "t")
    snapshots.upsert(table(spark, [("a", 1, 1)]), target, ["id"], "seq", 2)
    commit = snapshots.commit
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            snapshots.upsert(table(spark, [("a", 2, 2)]), target, ["id"], "seq")
    assert rows(snapshots.read_keyed(spark, target), "id", "v") == [("a", 1)]
    raced = []

    def beaten(session, place, told):
        if not raced:
            raced.append(1)
            snapshots.upsert(table(spark, [("b", 7, 7)]), target, ["id"], "seq")
        commit(session, place, told)

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", beaten)
        assert snapshots.upsert(table(spark, [("a", 3, 3)]), target, ["id"], "seq") == 3
    assert rows(snapshots.read_keyed(spark, target), "id", "v") == [("a", 3), ("b", 7)]
    with pytest.raises(snapshots.CommitConflict):
        commit(spark, target, snapshots.manifest(spark, target))


def test_a_delta_committed_during_compaction_stays(spark, monkeypatch):
    target = shared_dir(spark, "t")
    snapshots.upsert(table(spark, [("a", 1, 1), ("b", 1, 1)]), target, ["id"])
    commit, raced = snapshots.commit, []

    def beaten(session, place, told):
        if not raced:
            raced.append(1)
            snapshots.upsert(table(spark, [("a", 5, 0)]), target, ["id"])
        commit(session, place, told)

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", beaten)
        snapshots.compact(spark, target)
    assert len(snapshots.manifest(spark, target)["deltas"]) == 1
    assert rows(snapshots.read_keyed(spark, target), "id", "v") == [("a", 5), ("b", 1)]


def test_a_batch_number_counts_once_and_other_keys_are_refused(spark):
    target = shared_dir(spark, "t")
    assert snapshots.upsert(table(spark, [("a", 1, 1)]), target, ["id"], writer="q", number=4) == 1
    assert snapshots.upsert(table(spark, [("a", 9, 9)]), target, ["id"], writer="q", number=4) is None
    assert snapshots.upsert(table(spark, [("c", 1, 1)]).where("false"), target, ["id"]) is None
    with pytest.raises(ValueError, match="keys"):
        snapshots.upsert(table(spark, [("a", 1, 1)]), target, ["v"])
    wider = spark.createDataFrame([("b", 2, 2, "x")], "id string, v int, seq int, extra string")
    snapshots.upsert(wider, target, ["id"])
    assert rows(snapshots.read_keyed(spark, target), "id", "v", "extra") == [("a", 1, None), ("b", 2, "x")]
    with pytest.raises(ValueError, match="column v"):
        snapshots.upsert(wider.withColumn("v", F.lit("text")), target, ["id"])


def test_vacuum_keeps_what_manifests_name(spark):
    target = shared_dir(spark, "t")
    for v in range(3):
        snapshots.upsert(table(spark, [("a", v, v)]), target, ["id"])
    snapshots.compact(spark, target)
    assert snapshots.vacuum(spark, target) == []
    assert len(snapshots.vacuum(spark, target, older_than_seconds=-5)) == 3
    assert snapshots.versions(spark, target) == [4]
    assert rows(snapshots.read_keyed(spark, target), "id", "v") == [("a", 2)]


def test_base_rows_are_not_shuffled_by_a_small_delta(spark):
    target = shared_dir(spark, "t")
    many = spark.range(2000).selectExpr("CAST(id AS STRING) AS id", "1 AS v", "1 AS seq")
    snapshots.upsert(many, target, ["id"], buckets=2)
    snapshots.compact(spark, target)
    snapshots.upsert(many.limit(3), target, ["id"])
    plan = explained(snapshots.read_keyed(spark, target))
    assert "BroadcastHashJoin LeftAnti" in plan and "SortMergeJoin" not in plan


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    out = upsert.latest_per_key(df, ["k"], F.col("v").desc())
    assert out.filter("k = 0").first()["v"] == 999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") and "Partial" in plan


def test_reload_window_drops_days_without_rows(spark, monkeypatch):
    target = shared_dir(spark, "r")
    now = datetime(2024, 1, 10, 9)
    first = spark.sql("SELECT timestamp_ntz'2024-01-05 01:00:00' + make_dt_interval(CAST(id AS INT)) AS ts, id FROM range(6)")
    snapshots.reload_days(first, target, "ts", 3, now)
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            snapshots.reload_days(first.filter("id = 3"), target, "ts", 3, now)
    assert snapshots.read_days(spark, target).count() == 6
    snapshots.reload_days(first.filter("id = 3"), target, "ts", 3, now)
    assert [r[0] for r in rows(snapshots.read_days(spark, target), "id")] == [0, 1, 3]
    days = snapshots.manifest(spark, target)["days"]
    assert "2024-01-08" in days and "2024-01-09" not in days
    assert snapshots.read_days(spark, target, 1).count() == 6


def test_older_days_gain_only_what_they_lack(spark, monkeypatch):
    target, now = shared_dir(spark, "r"), datetime(2024, 3, 1)
    frame = spark.sql("SELECT IF(id % 4 = 3, NULL, timestamp_ntz'2024-01-05' + make_dt_interval(CAST(id % 3 AS INT))) AS ts, id % 6 AS id FROM range(24)")
    assert snapshots.reload_days(frame, target, "ts", 3, now) == 1
    monkeypatch.setattr(snapshots, "_lacking", lambda *a: pytest.fail("equal days were read"))
    assert snapshots.reload_days(frame, target, "ts", 3, now) is None
    monkeypatch.undo()
    more = frame.unionByName(frame.where("ts IS NULL")).unionByName(frame.where("id = 1").limit(1))
    assert snapshots.reload_days(more, target, "ts", 3, now) == 2
    assert snapshots.reload_days(more, target, "ts", 3, now) is None
    assert snapshots.reload_days(frame, target, "ts", 3, now) is None
    held = snapshots.read_days(spark, target)
    assert rows(held, "ts", "id") == rows(more, "ts", "id") and held.columns == ["ts", "id", "load_day"]


def test_target_name(spark):
    df = spark.createDataFrame([("2024-12-30",)], "d string")
    assert df.select(upsert.target_name("i", "d", "YYYY-MM-dd"), upsert.target_name("i", "d", None)).first()[:] == (
        "i-2024-12-30", "i")


def test_file_sink_modes(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    path = str(tmp_path / "out")
    sink = {"action": "file", "format": "parquet", "output_location": path, "partition_cols": "p"}
    core.write_output(df, 0, sink)
    core.write_output(df, 0, sink)
    assert spark.read.parquet(path).count() == 4
    core.write_output(df.filter("p = 'a'"), 0, {**sink, "mode": "overwrite"})
    assert rows(spark.read.parquet(path), "p", "v") == [("a", 1)]
    replay = {**sink, "output_location": str(tmp_path / "idem"), "idempotent": "true"}
    core.write_output(df, "7-x", replay)
    core.write_output(df, "7-x", replay)
    assert spark.read.parquet(replay["output_location"]).count() == 2


def test_staged_append_and_fresh(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(3)
    files.stage(df, path, "json")
    files.stage(df, path, "json")
    assert spark.read.json(path).count() == 6
    files.stage(df, path, "json", fresh=True)
    assert spark.read.json(path).count() == 3
    assert delete_path(spark, path) and not path_exists(spark, path)


def test_sink_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise OSError("busy")

    core.with_retry(flaky, 2, 0)
    assert len(calls) == 2
    with pytest.raises(OSError):
        core.with_retry(lambda: (_ for _ in ()).throw(OSError("down")), 2, 0)


def test_jdbc_statements():
    assert rdb.merge_statement("t", "s1", ["id", "a", "b"], ["id"]) == (
        "merge into t as t using s1 as s on t.id = s.id when matched then update set a = s.a, b = s.b"
        " when not matched then insert (id, a, b) values (s.id, s.a, s.b)")
    assert rdb.delete_statement("t", "ts", 2, datetime(2024, 1, 10, 5)) == "delete from t where ts >= '2024-01-08 00:00:00'"
    assert rdb.connection_options({"url": "u", "driver": "d", "user": "", "database": "x"}) == {"url": "u", "driver": "d", "dbname": "x"}


def test_the_last_row_of_a_batch_wins_without_an_order(spark, tmp_path):
    batch = spark.createDataFrame([(1, i) for i in range(6)], "k int, seq int").coalesce(1)
    snapshots.upsert(batch, str(tmp_path / "t"), ["k"])
    assert [r.seq for r in snapshots.read_keyed(spark, str(tmp_path / "t")).collect()] == [5]


def test_the_number_of_buckets_stays(spark, tmp_path):
    batch = spark.range(100).withColumnRenamed("id", "k")
    for buckets in (16, 64):
        snapshots.upsert(batch, str(tmp_path / "t"), ["k"], buckets=buckets)
    assert snapshots.read_keyed(spark, str(tmp_path / "t")).count() == 100


def test_a_repeated_reload_adds_nothing(spark, tmp_path):
    from datetime import datetime

    df = spark.range(24).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(id) AS ts")
    for _ in range(2):
        snapshots.reload_days(df, str(tmp_path / "t"), "ts", 5, datetime(2024, 1, 20))
    assert snapshots.read_days(spark, str(tmp_path / "t")).count() == 24
