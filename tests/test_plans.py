"""The catalog as a whole: names, twins, and the shape of the physical plans."""

import subprocess
import sys

import pytest

from conftest import SF, explained, rows
from sluicework import catalog
from sluicework.catalog import fixtures, streams
from sluicework.operators import codec, timerange

LAZY = [name for name in catalog.queries() if name not in streams.CATALOG.queries]


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert len(catalog.queries()) >= 105


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins(spark, name):
    plan = explained(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bucket_plan_reads_only_the_time_column(spark):
    plan = explained(timerange.bucket_plan(spark.read.parquet(f"{SF}/events.parquet"), "ts", 100))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan and "event_type" not in plan


def test_spec_sql_prunes_columns(spark):
    plan = explained(catalog.queries()["spec_vars"](spark, SF))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan


def test_filters_do_not_repeat_the_parse(spark):
    rows = fixtures.kafka_events(spark, SF)
    parsed = codec.decode(rows, "json", "event_id BIGINT, event_type STRING").filter("event_id > 5 AND event_type <> 'x'")
    assert explained(parsed).count("from_json(") == 1


def test_latest_run_is_limited_before_the_shuffle(spark):
    plan = explained(catalog.queries()["latest_run"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2


def test_range_source_travels_whole(spark, tmp_path):
    """It unpickles in a process that cannot import the package."""
    from datetime import datetime

    from pyspark import cloudpickle

    from sluicework.streaming.ranges import TimeRanges, range_stream

    range_stream(spark, datetime(2024, 1, 1), 1, "days", datetime(2024, 1, 2))
    blob = tmp_path / "source.pkl"
    blob.write_bytes(cloudpickle.dumps(TimeRanges))
    code = (
        "import pickle, sys; source = pickle.load(open(sys.argv[1], 'rb'));"
        "reader = source({'start': '2024-01-01', 'cap': '1', 'unit': 'days', 'until': '2024-01-01T05:00:00'}).simpleStreamReader(None);"
        "print(list(reader.read(reader.initialOffset())[0]), 'sluicework' in sys.modules)")
    done = subprocess.run([sys.executable, "-c", code, str(blob)], cwd="/tmp", capture_output=True, text=True, timeout=60)
    assert done.stdout.strip().endswith("[('2024-01-01T00:00:00', '2024-01-01T05:00:00')] False"), done.stderr


def test_approximate_counts_keep_no_sketch_for_each_value(spark, tmp_path):
    spark.createDataFrame([("F", 1), ("F", 1), ("F", 2), ("F", None), ("O", None), (None, 3)],
                          "l_linestatus string, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = catalog.queries()["sql_approx_distinct"](spark, str(tmp_path))
    assert "merge_approx_count_distinct" not in explained(found)
    assert rows(found) == sorted([("F", True), ("O", False), (None, True)], key=repr)
