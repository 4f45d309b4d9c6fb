from datetime import datetime, timedelta

import pytest

from conftest import rows
from sluicework.streaming import incidents

T0 = datetime(2024, 1, 1)


def at(*minutes):
    return [T0 + timedelta(minutes=m) for m in minutes]


def raised(spark, tmp_path, batches, **options):
    """The alerts a stream raises; it is started anew for every batch."""
    schema = "name string, alert_time timestamp, state string"
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = incidents.suppressed(stream, **options).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
    return rows(spark.read.parquet(str(tmp_path / "out")), "name", "alert_time")


@pytest.fixture
def store(spark):
    before = spark.conf.get(incidents.PROVIDER)
    spark.conf.set(incidents.PROVIDER, incidents.STATE_STORE)
    yield
    spark.conf.set(incidents.PROVIDER, before)


def test_an_hour_of_silence_over_restarts(spark, tmp_path, store):
    first = [("a", t, "FAILED") for t in at(50, 0, 61, 60)] + [("b", T0, None), (None, T0, "x"), ("c", None, "x"), ("a", T0, "FAILED")]
    second = [("a", t, "KILLED") for t in at(122, 90, 121)] + [("b", t, "x") for t in at(60, 61)]
    assert raised(spark, tmp_path, [first, second]) == [
        ("a", at(0)[0]), ("a", at(61)[0]), ("a", at(122)[0]), ("b", at(0)[0]), ("b", at(61)[0])]


def test_state_goes_with_the_watermark(spark, tmp_path, store):
    batches = [[("a", T0, "x")], [("z", T0 + timedelta(days=2), "x")], [("y", T0 + timedelta(days=2), "x"), ("a", T0 + timedelta(days=2), "x")]]
    assert raised(spark, tmp_path, batches, delay="1 minute") == [
        ("a", T0), ("a", T0 + timedelta(days=2)), ("y", T0 + timedelta(days=2)), ("z", T0 + timedelta(days=2))]


def test_only_streams(spark):
    with pytest.raises(ValueError, match="stream"):
        incidents.suppressed(spark.createDataFrame([("a", T0)], "name string, alert_time timestamp"))


def test_folded():
    assert incidents.folded(at(0, 60, 61, 100, 121.5)) == at(0, 61, 121.5)
    assert incidents.folded([]) == []
