import math

import pytest

from pyspark.sql import functions as F

from conftest import explained, rows
from sluicework.operators import quality


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, 2.0, "a"), (2, 2.0, None), (2, -1.0, "b"), (None, None, "a")], "k int, v double, s string")


def metric(frame, instance, name):
    return frame.filter((frame.instance == instance) & (frame.name == name)).first()["value"]


def test_profile(df):
    p = quality.profile(df, ["k"], ["k", "s"], ["v"], ["k", "v"]).cache()
    assert p.columns == ["entity", "instance", "name", "value"]
    assert metric(p, "*", "Size") == 4
    assert metric(p, "k", "Completeness") == 0.75
    assert metric(p, "k", "CountDistinct") == 2 and metric(p, "s", "CountDistinct") == 2
    assert (metric(p, "v", "Minimum"), metric(p, "v", "Mean"), metric(p, "v", "Maximum")) == (-1, 1, 2)
    third = 1 / 3
    assert metric(p, "k", "Entropy") == pytest.approx(-(third * math.log(third) + 2 * third * math.log(2 * third)))
    assert p.filter("entity = 'Dataset'").count() == 1


def test_profile_of_empty_frame(df):
    p = quality.profile_all(df.filter("false"))
    assert metric(p, "*", "Size") == 0
    assert metric(p, "k", "Completeness") is None


def test_checksum_null_safety(spark):
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    assert quality.row_checksum(df).select("md5").distinct().count() == 2
    assert quality.row_checksum(df, null_safe=False).select("md5").distinct().count() == 1


def test_diff_counts_copies(df, spark):
    assert quality.dataset_diff(df, df).isEmpty()
    twice = df.unionByName(df.filter("k = 1"))
    assert rows(quality.dataset_diff(twice, df), "side", "copies") == [("left", 1)]
    assert rows(quality.dataset_diff(df.filter("k = 2"), df), "side", "copies") == [("right", 1), ("right", 1)]
    assert quality.missing_checksums(df, twice).isEmpty()


def test_metric_diff(df):
    p = quality.profile(df, ["k"], numeric=["v"])
    assert quality.metric_diff(p, p).isEmpty()
    q = quality.profile(df.filter("v > 0"), ["k"], numeric=["v"])
    assert {(r["name"], r["side"]) for r in quality.metric_diff(p, q).collect()} == {
        (n, s) for n in ("Size", "Completeness", "Minimum", "Mean") for s in ("left", "right")}


def test_constraints(spark):
    df = spark.createDataFrame([(i, i % 2, None if i == 3 else i) for i in range(20)], "u int, d int, g int")
    found = set(map(tuple, quality.suggest_constraints(df).collect()))
    assert found == {("u", "complete"), ("u", "unique"), ("u", "non_negative"), ("d", "complete"), ("d", "non_negative"),
                     ("d", "small_domain"), ("g", "non_negative")}


def test_a_null_is_no_text(spark):
    df = spark.createDataFrame([(None,), ("\0",), ("\\\0",), ("",), ("\\",)], "a string")
    assert quality.row_checksum(df).select("md5").distinct().count() == 5
    left, right = (spark.createDataFrame([(v,)], "a string") for v in (None, "\0"))
    assert quality.dataset_diff(left, right).count() == 2
    assert quality.digest_diff(left, right).count() == 2


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_digest_diff_is_the_whole_diff(spark, keys):
    left = spark.range(3000).selectExpr("id AS k", "IF(id % 3 = 0, NULL, id % 50) AS v", "CAST(id % 7 AS STRING) AS s")
    right = left.where("k % 900 <> 1").unionByName(left.where("k IN (5, 6)")).withColumn("v", F.expr("IF(k = 12, 0, v)"))
    want = rows(quality.dataset_diff(left, right), "md5", "side", "copies")
    assert rows(quality.digest_diff(left, right, keys), "md5", "side", "copies") == want and len(want) == 8
    assert rows(quality.digest_diff(left, right, keys, ranges=1), "md5", "side", "copies") == want
    swapped = left.where("k = 1").select("k", F.lit(None).cast("bigint").alias("v"), F.lit("1").alias("s"))
    moved = left.where("k = 1").select("k", F.lit(1).cast("bigint").alias("v"), F.lit(None).cast("string").alias("s"))
    assert quality.digest_diff(swapped, moved).count() == 2


def test_equal_frames_shuffle_digests_alone(spark):
    df = spark.range(500).selectExpr("id AS k", "id % 9 AS v")
    plan = explained(quality.differing_ranges(df, df.orderBy("v")))
    assert plan.count("HashAggregate") >= 2
    same = quality.digest_diff(df, df.repartition(3))
    assert same.isEmpty() and "Range" not in explained(same)
    with pytest.raises(ValueError, match="columns"):
        quality.digest_diff(df, df.withColumn("v", F.lit("a")))
