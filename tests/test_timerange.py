from bisect import bisect_right
from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from conftest import explained, rows
from sluicework.functions import dates
from sluicework.operators import timerange
from sluicework.plans import backfill
from sluicework.session import shared_dir
from sluicework.sources import changes, fetched

T0 = datetime(2024, 1, 1, 23, 59, 58)


def at(*seconds):
    return [(T0 + timedelta(seconds=s),) for s in seconds]


def frame(spark, values):
    return spark.createDataFrame(values, "ts timestamp_ntz")


def test_plan_and_ranges_example(spark):
    """Counts 1,1,1,2,1 with a buffer of 3 -> buckets 0,0,1,1,2 over midnight."""
    df = frame(spark, at(0, 1, 2, 3, 3, 4))
    plan = timerange.bucket_plan(df, "ts", 3)
    assert [tuple(r) for r in plan.orderBy("second_ts").select("row_count", "running_count", "bucket").collect()] == [
        (1, 1, 0), (1, 2, 0), (1, 3, 1), (2, 5, 1), (1, 6, 2)]
    t = [T0 + timedelta(seconds=s) for s in range(5)]
    end = datetime(2024, 1, 3)
    assert rows(timerange.bucket_ranges(plan, end)) == [(0, t[0], t[2]), (1, t[2], t[4]), (2, t[4], end)]
    assert rows(timerange.bucket_ranges(plan))[-1] == (2, t[4], None)


def test_single_bucket_is_cut_at_its_last_second(spark):
    plan = timerange.bucket_plan(frame(spark, at(0, 5)), "ts", 100)
    assert rows(timerange.bucket_ranges(plan)) == [(0, T0, T0 + timedelta(seconds=5)), (0, T0 + timedelta(seconds=5), None)]
    one = timerange.bucket_plan(frame(spark, at(3, 3)), "ts", 100)
    assert rows(timerange.bucket_ranges(one)) == [(0, T0 + timedelta(seconds=3), None)]
    assert timerange.bucket_ranges(timerange.bucket_plan(frame(spark, []), "ts", 5)).isEmpty()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 300_000), min_size=1, max_size=40), st.integers(1, 9))
def test_ranges_tile_the_series(spark, seconds, buffer_size):
    df = frame(spark, at(*seconds))
    plan = timerange.bucket_plan(df, "ts", buffer_size)
    ranges = sorted((r["start_ts"], r["end_ts"]) for r in timerange.bucket_ranges(plan, datetime(2030, 1, 1)).collect())
    assert ranges[0][0] == min(t for t, in at(*seconds))
    assert all(left[1] == right[0] for left, right in zip(ranges, ranges[1:]))
    assert ranges[-1][1] == datetime(2030, 1, 1)
    expected, total = {}, 0
    for second in sorted(set(seconds)):
        total += seconds.count(second)
        expected[T0 + timedelta(seconds=second)] = total // buffer_size
    assert {r["second_ts"]: r["bucket"] for r in plan.collect()} == expected


def test_hot_second_keeps_all_rows(spark):
    df = spark.range(3000).selectExpr(
        "id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, IF(id % 3 = 0, 7, CAST(id % 50 AS INT))) AS ts")
    out = timerange.bucketed_extract(df, "ts", 100, shared_dir(spark, "hot"))
    assert out.count() == 3000 and out.select("id").distinct().count() == 3000


def test_range_predicate_is_pushed(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    kept = df.filter(timerange.range_predicate(df, "ts", datetime(2024, 1, 2), "2024-01-03 00:00:00", "event_type = 'click'"))
    plan = explained(kept)
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan and "LessThan(ts,2024-01-03T00:00)" in plan
    assert kept.filter("ts < TIMESTAMP_NTZ '2024-01-02' OR ts >= TIMESTAMP_NTZ '2024-01-03'").isEmpty()


def test_range_query_text():
    assert timerange.range_query("a, b", "t", "ts", "s", "e", "x = 1", True) == (
        "SELECT a, b FROM t WHERE ts >= 's' AND ts < 'e' AND (x = 1) LIMIT 1")
    assert timerange.range_query("*", "t", "ts") == "SELECT * FROM t"


def test_range_predicates_for_jdbc(spark):
    plan = timerange.bucket_plan(frame(spark, at(0, 1, 2)), "ts", 1)
    texts = timerange.range_predicates(timerange.bucket_ranges(plan), "ts")
    assert texts[0] == "ts >= TIMESTAMP('2024-01-01 23:59:58') AND ts < TIMESTAMP('2024-01-01 23:59:59')"
    assert texts[-2:] == ["ts >= TIMESTAMP('2024-01-02 00:00:00')", "ts IS NULL"]


def test_capped_end():
    now = datetime(2024, 1, 10, 0, 0, 59)
    minute = timedelta(minutes=1)
    assert dates.whole_unit_cap(now - timedelta(minutes=5, seconds=59), now, 5, minute) == now
    assert dates.whole_unit_cap(now - timedelta(minutes=6), now, 5, minute) == now - minute
    assert dates.whole_unit_cap(now + minute, now, 5, minute) == now + minute


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**7), st.integers(1, 60))
def test_offsets_advance_and_tile(gap_seconds, cap):
    now = datetime(2024, 6, 1)
    left, seen = now - timedelta(seconds=gap_seconds), []
    while left < now and len(seen) < 200_000:
        right = dates.whole_unit_cap(left, now, cap * 1000, timedelta(minutes=1))
        assert right > left
        seen.append((left, right))
        left = right
    assert left == now


def test_text_formats():
    assert dates.parse_text("2024-01-02T03:04:05Z") == dates.parse_text("2024-01-02 03:04:05") == datetime(2024, 1, 2, 3, 4, 5)
    assert dates.format_text(datetime(2024, 1, 2, 3, 4, 5)) == "2024-01-02T03:04:05Z"
    assert dates.format_text(datetime(2024, 1, 2, 3, 4, 5), "cdata") == "2024-01-02 03:04:05"


def test_bad_time_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.678Z",), ("nope",), (None,)], "v string")
    assert [r[0] for r in df.select(dates.iso_to_space("v")).collect()] == ["2024-01-02 03:04:05", None, None]


def test_requested_range():
    now = datetime(2024, 3, 10, 15)
    assert changes.requested_range({"last_n_days": "3", "start_time": "2000-01-01"}, now) == (datetime(2024, 3, 7), None)
    assert changes.requested_range({"start_time": "2024-01-01T00:00:00Z"}) == (datetime(2024, 1, 1), None)
    assert changes.requested_range({}) == (None, None)


def test_starting_point_policies(spark):
    df = frame(spark, at(5, 1))
    now = datetime(2024, 5, 1)
    base = {"offset_column": "TS"}
    assert changes.starting_point(lambda: df, base, now) == T0 + timedelta(seconds=1)
    assert changes.starting_point(lambda: df, {**base, "starting_offset": "latest"}, now) == now - timedelta(seconds=5)
    assert changes.starting_point(lambda: df, {**base, "starting_offset": "2024-02-02T00:00:00Z"}, now) == datetime(2024, 2, 2)
    assert changes.starting_point(lambda: frame(spark, []), base, now) is None
    assert changes.starting_point(None, {}, now, "last_minute") == now - timedelta(minutes=1)
    with pytest.raises(ValueError, match="not found"):
        changes.offset_column(df, {"offset_column": "gone"})


def test_slices_tile():
    cut = fetched.slices(datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30), 60)
    assert cut == [(datetime(2024, 1, 1), datetime(2024, 1, 1, 1)), (datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1, 30))]
    assert fetched.slices(datetime(2024, 1, 1), datetime(2024, 1, 1), 60) == []
    many = fetched.slices(datetime(2000, 1, 1), datetime(2024, 1, 1), 600)
    assert len(many) == 21_039 and many[-1] == (datetime(2023, 12, 31, 20), datetime(2024, 1, 1))


def test_range_predicates_ask_for_what_the_direct_read_asks(spark):
    ranges = spark.createDataFrame(
        [(0, datetime(2024, 1, 1, 5), datetime(2024, 1, 2)), (1, datetime(2024, 1, 2), None)], "bucket int, start_ts timestamp_ntz, end_ts timestamp_ntz")
    start, end = datetime(2024, 1, 1, 5, 0, 0, 250000), datetime(2024, 1, 3)
    assert timerange.range_predicates(ranges, "ts", start, end, "odd = 1") == [
        "ts >= TIMESTAMP('2024-01-01 05:00:00.250000') AND ts < TIMESTAMP('2024-01-02 00:00:00') AND (odd = 1)",
        "ts >= TIMESTAMP('2024-01-02 00:00:00') AND ts < TIMESTAMP('2024-01-03 00:00:00') AND (odd = 1)"]
    assert timerange.range_predicates(ranges, "ts")[-1] == "ts IS NULL"


def test_rows_without_a_time_stay_in_a_bucketed_extract(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "IF(id % 10 = 0, NULL, TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 0, id)) AS ts")
    rows_ = timerange.extract(df, "ts", 10, str(tmp_path / "b"))
    assert rows_.count() == 100 and rows_.where("ts is null").count() == 10


def test_backfill_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 3),), (date(2024, 1, 1),)], "d date")
    today = date(2024, 1, 7)
    seen = []
    assert backfill.backfill(lambda v: seen.append(v["date"]), df, "d", today=today) == [date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 6)]
    assert seen == ["2024-01-04", "2024-01-05", "2024-01-06"]
    assert backfill.days_to_run(df, "d", today=date(2024, 1, 4)) == []
    assert backfill.days_to_run(df, "d", only="2024-02-29") == [date(2024, 2, 29)]
    with pytest.raises(ValueError):
        backfill.requested_day("2024-02-30")


def test_range_extract_is_even_and_writes_few_files(spark, tmp_path):
    df = spark.range(20000).selectExpr(
        "id", "IF(id % 4 = 0, TIMESTAMP_NTZ '2024-01-05', TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 0, CAST(id * 7 % 500000 AS INT))) AS ts")
    cuts = timerange.time_cuts(df, "ts", 1000)
    assert len(cuts) == 19 and len(set(cuts)) < 19
    staged = timerange.range_partitioned_extract(df, "ts", 1000, str(tmp_path / "few"))
    sizes = [r["count"] for r in staged.groupBy("bucket").count().collect()]
    assert sum(sizes) == 20000 and max(sizes) <= 1000 and len(sizes) <= 45
    many = timerange.range_partitioned_extract(df, "ts", 10, str(tmp_path / "many"))
    assert many.select("bucket").distinct().count() >= 2000
    assert len(many.inputFiles()) <= 8
    plan = explained(df.withColumn("r", timerange.range_of(timerange.micros_of(df, "ts"), cuts)))
    assert "Join" not in plan and "Exchange" not in plan


def test_ranges_of_cuts(spark):
    cuts = [10, 20, 20, 20, 30, 40, 50, 60, 70]
    got = spark.range(0, 80).select("id", timerange.range_of(F.col("id"), cuts).alias("r")).collect()
    for row in got:
        want = {sum(c <= row.id for c in cuts)} if row.id != 20 else {2, 3, 4}
        assert row.r in want
    assert [r.r for r in spark.range(3).select(timerange.range_of(F.col("id"), []).alias("r")).collect()] == [0, 0, 0]


def test_many_cuts_are_searched_once_by_halving(spark):
    cuts = sorted([*range(0, 8000, 2), *[4000] * 7])
    found = timerange.range_of(F.col("id"), cuts)
    # One walk over the halvings, not one over blocks of cuts for each use of the result.
    plan = spark.range(1).select(found.alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("aggregate(") == 1 and "filter(" not in plan
    got = spark.range(-3, 8003).select("id", found.alias("r")).collect()
    assert all(row.r == bisect_right(cuts, row.id) for row in got if row.id != 4000)
    dealt = spark.range(4000).select(timerange.range_of(F.lit(4000), cuts).alias("r"))
    assert {row.r for row in dealt.distinct().collect()} == set(range(2001, 2009))
    none = spark.range(1).select(timerange.range_of(F.lit(None).cast("bigint"), cuts).alias("r"))
    assert [row.r for row in none.collect()] == [0]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_range_extract_of_other_types_nulls_and_no_rows(spark, tmp_path, kind):
    df = spark.range(50).selectExpr("id", f"CAST(IF(id % 5 = 0, NULL, TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id AS INT))) AS {kind}) AS at")
    staged = timerange.range_partitioned_extract(df, "at", 8, str(tmp_path / "t"))
    assert staged.count() == 50 and staged.where("bucket IS NULL").count() == 10
    ordered = [r.id for r in staged.where("bucket IS NOT NULL").groupBy("bucket").agg(F.min("id").alias("id")).orderBy("bucket").collect()]
    assert ordered == sorted(ordered) and len(ordered) > 3
    assert timerange.range_partitioned_extract(df.where("false"), "at", 8, str(tmp_path / "e")).count() == 0
